"""Repeated lines and passages against a plain version."""

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import LOWER, ODD_ROWS, WORD, documents, random_text, rng

from tierwork.llm import repeats
from tierwork.llm.words import ALPHANUMERIC, words_of


def word_hash(word):
    return int(words_of(pa.array([word]), ALPHANUMERIC).hashes[0])


def units(text):
    """Units as (words, first character), cut by looking at every word's neighbours."""
    found = []
    lowered = (text or "").translate(LOWER)
    lines = []
    for match in WORD.finditer(lowered):
        line = lowered.count("\n", 0, match.start())
        if not lines or lines[-1][0] != line:
            lines.append((line, []))
        lines[-1][1].append((match.group(), match.start()))
    for _, line in lines:
        hashes = [word_hash(word) for word, _ in line]
        unit = []
        for i, (word, start) in enumerate(line):
            unit.append((word, start))
            before = hashes[max(0, i - repeats.REACH) : i]
            after = hashes[i + 1 : i + 1 + repeats.REACH]
            if all(hashes[i] < h for h in before) and all(hashes[i] <= h for h in after):
                found.append(unit)
                unit = []
        if unit:
            found.append(unit)
    return [(tuple(w for w, _ in unit), unit[0][1]) for unit in found]


def windows(found):
    """Per unit the words from it on, if there are enough in whole units, and the unit behind them."""
    result = []
    for i in range(len(found)):
        words, j = (), i
        while j < len(found) and len(words) < repeats.LEAST_WORDS:
            words, j = (*words, *found[j][0]), j + 1
        result.append((words if len(words) >= repeats.LEAST_WORDS else None, j))
    return result


def plain(rows):
    """What is left of each text, and what went."""
    own = [units(text) for _, text in rows]
    first = {}
    for (doc_id, _), found in zip(rows, own):
        for words, _ in windows(found):
            key = (doc_id is None, doc_id)
            if words not in first or key < first[words]:
                first[words] = key
    result = []
    for (doc_id, text), found in zip(rows, own):
        seen, marks = set(), [False] * len(found)
        for i, (words, j) in enumerate(windows(found)):
            if words and (words in seen or first[words] != (doc_id is None, doc_id)):
                marks[i:j] = [True] * (j - i)
            seen.add(words)
        spans, i = [], 0
        while i < len(found):
            j = i
            while j < len(found) and marks[j] == marks[i]:
                j += 1
            if marks[i]:
                spans.append((found[i][1], found[j][1] if j < len(found) else len(text)))
            i = j
        left, at = "", 0
        for start, stop in spans:
            left, at = left + text[at:start], stop
        result.append((doc_id, None if text is None else left + text[at:], len(found), sum(marks), spans))
    return result


def check(spark, rows):
    docs = documents(spark, [(i, t, "en", "s") for i, t in rows])
    found = repeats.deduplicated(docs)
    got = [
        (r["document"]["doc_id"], r["document"]["text"], r["n_units"], r["n_removed"], [(s["start"], s["end"]) for s in r["removed"]])
        for r in found.collect()
    ]
    assert sorted(map(str, got)) == sorted(map(str, plain(rows)))
    assert found.select("document.*").columns == docs.columns
    return found


def test_lines_and_passages(spark):
    r = rng(3)
    vocabulary = [f"{a}{b}{c}" for a in "abcdefgh" for b in "xyzuvwé" for c in "mnopqrst"]
    lines = [random_text(r, vocabulary, 15, 30).replace("\n", " ") for _ in range(10)]
    passage = random_text(r, vocabulary, 60, 60).replace("\n", " ")
    rows = []
    for i in range(60):
        parts = [random_text(r, vocabulary, 5, 60) for _ in range(3)]
        if i % 2:
            parts.insert(1, "\n" + r.choice(lines).upper() + "\n")
        if i % 3 == 0:
            parts.insert(2, passage)  # in the middle of a line
        rows.append((i, "".join(parts)))
    rows.append((100, rows[7][1]))
    found = {r["document"]["doc_id"]: r for r in check(spark, rows).collect()}
    left = {i: " ".join(r["document"]["text"].split()) for i, r in found.items()}
    middle = " ".join(passage.split()[15:45])
    assert middle in left[0] and not found[0]["removed"]
    assert not any(middle in left[i] for i in range(3, 60, 3))
    assert {s["first_doc"] for s in found[100]["removed"]} <= {None, *range(60)}


def test_a_passage_of_fifty_words_is_always_found(spark):
    """Pasted between words of other documents, wherever it begins; what stays of it is short."""
    r, rows = rng(4), []
    for n in range(60):
        passage = " ".join(f"p{n}x{r.randrange(10_000)}" for _ in range(51))
        for side in (0, 1):
            before, after = (" ".join(f"o{n}{side}{r.randrange(10_000)}" for _ in range(r.randint(0, 30))) for _ in "ab")
            rows.append((2 * n + side, f"{before} {passage} {after}"))
    left = {r["document"]["doc_id"]: r["document"]["text"] for r in check(spark, rows).collect()}
    assert all(sum(w.startswith("p") for w in left[2 * n].split()) == 51 for n in range(60))
    caught = [sum(w.startswith("p") for w in left[2 * n + 1].split()) < 51 for n in range(60)]
    assert sum(caught) >= 58


def test_odd_rows(spark):
    found = check(spark, [row[:2] for row in ODD_ROWS])
    assert found.filter("document.text is null").count() == 2


def test_repeats_inside_one_document(spark):
    line = " ".join(f"word{i}" for i in range(20))
    check(spark, [(1, f"{line}\n{line}\nown words\n{line}"), (None, line), (None, line)])


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, "a")]])
def test_little(spark, rows):
    check(spark, rows)


def test_emptied_documents_go(spark):
    line = " ".join(f"word{i}" for i in range(20)) + "."
    docs = documents(spark, [(51, line), (52, line), (53, line + "\nand words of its own, too"), *ODD_ROWS[:5]])
    kept = repeats.without_repeats(docs)
    assert kept.columns == docs.columns
    left = {r["doc_id"]: r for r in kept.filter("doc_id > 50").collect()}
    assert set(left) == {51, 53} and left[53]["text"] == "and words of its own, too"
    assert left[53]["n_chars"] == len(left[53]["text"]) and left[51]["n_chars"] == len(line)
    assert kept.count() == 2 + 5


def test_digests_depend_on_words_and_order_alone():
    found = words_of(pa.array(["a b c", "c b a", "x y a b c d"]), ALPHANUMERIC)
    one, two = repeats.span_digests(found, np.array([0, 3, 8, 8]), np.array([3, 6, 11, 12]))
    for digest in (one, two):
        assert digest[0] == digest[2] != digest[1] and digest[3] != digest[0]
    assert one[0] != two[0]


def compared(text):
    """Units and, for each that begins some, the spans compared: windows, whole lines and line ends."""
    found = units(text)
    lowered = (text or "").translate(LOWER)
    line = [lowered.count("\n", 0, start) for _, start in found]
    spans = {(i, j) for i, (words, j) in enumerate(windows(found)) if words}
    for number in set(line):
        first, stop = line.index(number), len(line) - line[::-1].index(number)
        spans.add((first, stop))
        ends = [i for i in range(first, stop) if sum(len(w) for w, _ in found[i:stop]) >= repeats.LEAST_WORDS]
        spans |= {(max(ends), stop)} if ends else set()
    return found, [(i, j, tuple(w for words, _ in found[i:j] for w in words)) for i, j in sorted(spans)]


def plain_lines(rows):
    """What is left of each text, and the characters that went, with whole lines compared too."""
    own = [compared(text) for _, text in rows]
    first = {}
    for (doc_id, _), (_, spans) in zip(rows, own):
        for *_, words in spans:
            key = (doc_id is None, doc_id)
            first[words] = min(first.get(words, key), key)
    result = []
    for (doc_id, text), (found, spans) in zip(rows, own):
        seen, marks = set(), [False] * len(found)
        for i, j, words in spans:
            if words in seen or first[words] != (doc_id is None, doc_id):
                marks[i:j] = [True] * (j - i)
            seen.add(words)
        left = "" if text is not None else None
        edges = [start for _, start in found] + [len(text or "")]
        if text is not None:
            left = text[: edges[0]] + "".join(
                text[a:b] for a, b, gone in zip(edges, edges[1:], marks) if not gone
            )
        result.append((doc_id, left, sum(marks)))
    return result


def check_lines(spark, rows):
    docs = documents(spark, [(i, t, "en", "s") for i, t in rows])
    found = repeats.deduplicated(docs, lines=True).collect()
    got = [(r["document"]["doc_id"], r["document"]["text"], r["n_removed"]) for r in found]
    assert sorted(map(str, got)) == sorted(map(str, plain_lines(rows)))
    return {doc_id: text for doc_id, text, _ in got}


def test_whole_lines_of_any_length_and_line_ends(spark):
    r = rng(5)
    vocabulary = [f"{a}{b}{c}" for a in "abcdefgh" for b in "xyzuvwé" for c in "mnopqrst"]
    lines = [" ".join(r.choice(vocabulary) for _ in range(n)) for n in (1, 2, 3, 5, 9, 11, 13, 20, 30)]
    rows = []
    for i in range(80):
        own = [f"{random_text(r, vocabulary, 20, 60)}" for _ in range(3)]
        rows.append((i, f"{own[0]}\n{lines[i % 9].title()}.\n{own[1]}\n{r.choice(lines)}\n{own[2]} {lines[8]}"))
    left = check_lines(spark, [*rows, *[row[:2] for row in ODD_ROWS]])
    for i in range(9, 80):
        assert lines[i % 9].title() not in left[i].split("\n")


def test_a_repeated_line_of_five_words_goes_between_lines_of_its_own(spark):
    line = "five words stand here again"
    rows = [(i, f"own{i} first line\n{line}\nown{i} last line") for i in range(20)]
    left = check_lines(spark, rows)
    assert line in left[0] and not any(line in left[i] for i in range(1, 20))
    docs = documents(spark, [*rows, (99, line)])
    kept = {r["doc_id"]: r["text"] for r in repeats.without_repeats(docs).collect()}
    assert set(kept) == set(range(20)) and kept[7] == "own7 first line\nown7 last line"


def test_little_lines(spark):
    check_lines(spark, [])
    check_lines(spark, [(1, None), (2, "a\na\nb"), (None, "a"), (None, "c"), (3, "\n!\nb")])
