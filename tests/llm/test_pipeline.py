"""The stages one after the other against their brute-force versions, and the queries against their SQL."""

import base64

import duckdb
import public_tokenizers
import pytest
import tiktoken
from test_decontaminate import brute as leaks_of
from test_jaccard_join import brute as components_of
from test_jaccard_join import shingle_set
from test_language_id import learn, predict
from test_line_dedup import brute as cut_lines

import __spark_entry__
import corpus_pipeline
from docweave.llm.queries import ORACLES, QUERIES
from docweave.llm.tables import stored

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def brute_stages(rows, items):
    """After each stage: {doc_id: text}; the last has the ids."""
    profiles = learn([(r["text"], r["lang"]) for r in rows])
    docs = {r["doc_id"]: r["text"] for r in rows if predict(profiles, r["text"])[0] != "und"}
    out = [dict(docs)]
    cut = cut_lines(docs.items())
    docs = {d: t for d, (_, gone, t) in cut.items() if not gone or t.strip(" \t\r\n")}
    out.append(dict(docs))
    keep = {c for d, n, c in components_of(list(docs.items())) if n}
    docs = {d: t for d, t in docs.items() if d in keep or not shingle_set(t)}
    out.append(dict(docs))
    leaky = {d for d, *_ in leaks_of(list(docs.items()), items)}
    docs = {d: t for d, t in docs.items() if d not in leaky}
    out.append(dict(docs))
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    out.append({d: library.encode_ordinary(t) for d, t in docs.items()})
    return out


def test_stages_against_brute_force(spark):
    table = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [r.asDict() for r in table.collect()]
    rows += [
        {"doc_id": 10_000, "text": "12 + 34 = 46!", "lang": "en"},
        {"doc_id": 10_001, "text": None, "lang": None},
        {"doc_id": 10_002, "text": "", "lang": "en"},
        {"doc_id": 10_003, "text": rows[0]["text"], "lang": None},
    ]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    want = brute_stages(rows, items)
    docs = spark.createDataFrame([tuple(r.get(c) for c in COLUMNS) for r in rows], table.schema)
    for (name, stage), expected in zip(corpus_pipeline.STAGES, want, strict=True):
        docs = stage(spark, docs, FOLDER)
        if name == "byte_bpe":
            got = {r.doc_id: (list(r.ids), r.n_tokens, r.round_trip) for r in docs.collect()}
            assert got == {d: (ids, len(ids), True) for d, ids in expected.items()}
        else:
            assert docs.columns == COLUMNS
            docs = stored(docs)
            assert {r.doc_id: r.text for r in docs.collect()} == expected, name
    assert [len(w) for w in want] == sorted((len(w) for w in want), reverse=True)
    assert len(want[0]) > len(want[1]) > len(want[2]) > len(want[3]) == len(want[4])


def test_run_and_odd_tables(spark, documents, tmp_path):
    odd = documents([(1, "the one and only text here"), (1, "the one and only text here"), (None, "no id at all in this one"), (2, None), (3, ""), (4, "word " * 50_000)])
    for name, docs in (("odd", odd), ("none", documents([]))):
        folder = str(tmp_path / name)
        docs.write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([(1, None), (None, "a b")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
        got = corpus_pipeline.run(spark, folder).collect()
        assert sorted((r.doc_id is None, r.doc_id) for r in got) == ([(False, 1), (False, 4), (True, None)] if name == "odd" else [])
        assert all(r.round_trip for r in got)


@pytest.mark.parametrize("name", [n for n in ORACLES if n != "op8_warc"])
def test_queries_against_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    theirs = con.sql(ORACLES[name]).to_arrow_table()
    ours = QUERIES[name](spark, FOLDER).toArrow().select(theirs.column_names)
    assert sorted(map(str, ours.to_pylist())) == sorted(map(str, theirs.to_pylist()))


def test_all_are_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, 11))
    assert set(QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())
    assert set(ORACLES) <= set(__spark_entry__.oracle_sql())
