"""Plain Python versions of the operators, and the rows that every operator has to bear."""

from __future__ import annotations

import random
import re

from pyspark.sql import types as T

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

#: Names that the operators use inside, as columns of the documents.
EXTRA = ("row", "n", "digest", "cls", "slot", "removed", "gone", "others", "component", "label", "score")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def tokens(text):
    return TOKEN.findall((text or "").translate(LOWER))


def document_schema(extra=EXTRA):
    fields = [("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType())]
    fields += [("source", T.StringType()), ("n_chars", T.LongType())]
    return T.StructType([T.StructField(n, k) for n, k in fields + [(x, T.StringType()) for x in extra]])


def documents(spark, rows, extra=EXTRA):
    """Documents from (doc_id, text) or (doc_id, text, lang, source), with columns of odd names."""
    filled = []
    for row in rows:
        doc_id, text, *more = row
        lang, source = (*more, "en", "s")[:2] if more else ("en", "s")
        filled.append((doc_id, text, lang, source, None if text is None else len(text), *("x",) * len(extra)))
    return spark.createDataFrame(filled, document_schema(extra))


LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))

#: Nulls in every column, empty, blank and very long texts, repeated rows, ids and texts.
ODD_ROWS = [
    (None, None, None, None),
    (None, "only a null id here with some words to count", "en", None),
    (1, None, None, "s"),
    (2, "", "en", "s"),
    (3, " \t\n ", "en", None),
    (4, "word", "en", "s"),
    (4, "word", "en", "s"),
    (5, "!!! 123 ... ???", "de", "s"),
    (6, LONG, "en", "s"),
    (6, "the same id and another text of ten words it has", "en", "s"),
    (7, "Straße été niño \U0001f642 漢字 \x00   x", "fr", "s"),
    (8, "no\r\nline\r\n\r\nends", "en", "s"),
]


def random_text(rng, vocabulary, low, high):
    parts = []
    for _ in range(rng.randint(low, high)):
        parts.append(rng.choice(vocabulary))
        parts.append(rng.choice([" ", " ", " ", "\n", ", ", ". ", "  "]))
    return "".join(parts)


def rng(seed):
    return random.Random(seed)


def occurrences(document_words, window):
    n = len(window)
    return [i for i in range(len(document_words) - n + 1) if document_words[i : i + n] == window]


def contamination(text, items):
    """Words, hit words and the ids of the items that occur, by comparing every window."""
    own, hit, found = words(text), set(), set()
    for item_id, item in items:
        theirs = words(item)
        n = min(10, len(theirs))
        for start in range(len(theirs) - n + 1 if n else 0):
            for place in occurrences(own, theirs[start : start + n]):
                hit.update(range(place, place + n))
                if item_id is not None:
                    found.add(item_id)
    return len(own), len(hit), sorted(map(str, found))


def shingles(text, n=5):
    own = tokens(text)
    if not own:
        return frozenset()
    return frozenset(tuple(own[i : i + n]) for i in range(max(1, len(own) - n + 1)))


def near_components(rows, n=5, percent=75):
    """Per row the smallest id of its component, by comparing all pairs."""
    sets = [shingles(text, n) for _, text in rows]
    part = list(range(len(rows)))

    def root(x):
        while part[x] != x:
            x = part[x]
        return x

    for i, one in enumerate(sets):
        for j in range(i):
            common = len(one & sets[j])
            if common and 100 * common >= percent * (len(one) + len(sets[j]) - common):
                part[max(root(i), root(j))] = min(root(i), root(j))
    ids: dict[int, list] = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            ids.setdefault(root(i), []).append(doc_id)
    return [min(ids[root(i)]) if root(i) in ids else None for i in range(len(rows))]
