"""The registered queries against SQL, and the pipeline against a plain version."""

import hashlib

import public_tokenizers
import pytest
import sentencepiece
from compare import differences, duck
from llm_cases import contamination, documents, near_components, words
from test_repeats import plain_lines

import __spark_entry__ as contract
import corpus_pipeline
from tierwork.llm import languages, oracle, queries

SQL = oracle.oracle_sql()


@pytest.fixture(scope="module")
def connection(sf_dir):
    with duck(sf_dir) as open_connection:
        yield open_connection


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, sf_dir, connection, name):
    assert differences(queries.queries()[name](spark, sf_dir), connection, SQL[name]) == []


def test_every_operator_is_registered():
    names = contract.queries()
    assert {f"op{n}" for n in range(1, 11)} | {"op11", "op12", "op13"} == {name.split("_")[0] for name in queries.queries()}
    assert set(queries.queries()) | {"pipeline"} <= set(names)


@pytest.mark.parametrize("name", ["op4_neighbours", "op6_toxicity", "op7_quality", "op9_language", "op10_substrings"])
def test_query_gives_its_rows(spark, sf_dir, name):
    rows = queries.queries()[name](spark, sf_dir)
    wanted = 25 * 20 if name.startswith("op4") else spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert rows.count() == wanted
    assert rows.select([c for c in rows.columns if c in ("held_out", "predicted", "score")]).dropna().count() == wanted


def plain_pipeline(rows, filters, items):
    import pyarrow as pa

    kept = []
    for doc_id, text in rows:
        column = pa.array([text], pa.string())
        count = len(languages.text_grams(column)[0])
        share = filters.shares(column).max()
        wide = languages.BENEFIT**2
        highest = (share * count + wide / 2 + (wide * (share * (1 - share) * count + wide / 4)) ** 0.5) / (count + wide)
        known = not count or (share > 0 and highest >= corpus_pipeline.LEAST_LANGUAGE_SHARE)
        if text and any(map(str.isalpha, text)) and known:
            kept.append((doc_id, text))
    parts = near_components(kept)
    kept = [row for row, part in zip(kept, parts) if row[0] == part or not row[1].split()]
    left = [(doc_id, text) for doc_id, text, removed in plain_lines(kept) if words(text) or not removed]
    clean = [row for row in left if not contamination(row[1], items)[1]]
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    found = []
    for doc_id, text in clean:
        ids = library.encode(text, add_bos=True, add_eos=True)
        packed = b"".join(x.to_bytes(4, "little") for x in ids)
        decoded = library.decode(ids).encode()
        found.append((doc_id, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(decoded).hexdigest()))
    return found


def test_pipeline_agrees_with_a_plain_version(spark):
    small = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    wanted = plain_pipeline(rows, languages.learned(docs), items)
    got = [tuple(r) for r in corpus_pipeline.run(spark, small).collect()]
    assert sorted(got) == sorted(wanted) and 0 < len(got) < len(rows)


def test_stages_keep_the_columns(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf_dir).dtypes == docs.dtypes


def test_stages_bear_an_empty_table(spark, sf_dir):
    docs = documents(spark, [], extra=())
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf_dir).count() == 0
