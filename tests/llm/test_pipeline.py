"""The pipeline and each of its stages against plain versions."""

import hashlib
import zlib

import duckdb
import numpy as np
import public_tokenizers
import tiktoken

import corpus_pipeline
from pairgrade.llm import bpe, quality
from tests.llm import test_decontaminate, test_lines, test_near_dedup

SF = "/root/testdata/sf0.001"


def plain():
    con = duckdb.connect()
    rows = con.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    labels = dict(con.sql(f"SELECT doc_id, quality FROM '{SF}/labels.parquet'").fetchall())
    items = con.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
    steps = [rows]
    known = [(quality.features(np.frombuffer(t.encode(), np.uint8)), labels[i]) for i, t in rows
             if i in labels and zlib.crc32(str(i).encode()) % 5]
    known.sort(key=lambda x: (x[0].tobytes(), x[1]))
    model = quality.fit([r for r, _ in known], np.array([y for _, y in known], float))
    rows = [(i, t) for i, t in rows if model.score(quality.features(np.frombuffer(t.encode(), np.uint8))) >= 0.3]
    steps.append(rows)
    rows = kept_lines(rows)
    steps.append(rows)
    kept = {r[0] for r in test_near_dedup.brute(rows, 5) if r[3]}
    rows = [r for r in rows if r[0] in kept]
    steps.append(rows)
    clean = {r[0] for r in test_decontaminate.brute(rows, items) if not r[5]}
    rows = [r for r in rows if r[0] in clean]
    steps.append(rows)
    ranks = bpe.read_ranks(open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb").read())
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    out = []
    for i, t in rows:
        ids = library.encode_ordinary(t)
        out.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                    hashlib.sha256(t.encode()).hexdigest()))
    steps.append(out)
    return steps


def kept_lines(rows):
    """Documents left by line dedup, by comparing every two different lines."""
    first = {}
    for i, t in sorted(rows):
        for n, x in enumerate(t.split("\n")):
            if len(x) >= 20:
                first.setdefault(x, (i, n))
    near = set()
    by_size = sorted(first, key=len)
    for k, x in enumerate(by_size):
        for y in by_size[k + 1:]:
            if len(y) - len(x) > 2:
                break
            if test_lines.within(x, y, 2):
                near.add(max((x, y), key=first.get))
    out = []
    for i, t in rows:
        lines = t.split("\n")
        left = [x for n, x in enumerate(lines) if len(x) < 20 or (first[x] == (i, n) and x not in near)]
        if len(left) == len(lines) or any(left):
            out.append((i, "\n".join(left)))
    return out


def test_stages_match_plain_versions(spark, tmp_path):
    steps = plain()
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    docs = documents
    for (name, stage), want in zip(corpus_pipeline.STAGES, steps[1:]):
        docs = stage(spark, docs, SF)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.dtypes == documents.dtypes
            got = docs.select("doc_id", "text", "n_chars").collect()
            assert sorted((r.doc_id, r.text) for r in got) == sorted(want), name
            assert all(r.n_chars == len(r.text) for r in got)
        else:
            assert sorted(map(tuple, docs.collect())) == sorted(want)
        docs.write.parquet(path := str(tmp_path / name.replace(" ", "-")))
        docs = spark.read.parquet(path)
    assert len(steps[0]) > len(steps[1]) > len(steps[2]) > len(steps[4])


def test_run_and_odd_rows(spark, docs, tmp_path):
    base = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 60")
    extra = docs([(7000, None), (7001, ""), (None, "some words without an id"), (7002, "x" * 70000)]).select(
        "doc_id", "text").selectExpr("doc_id", "text", "'en' AS lang", "'s' AS source", "cast(length(text) as bigint) AS n_chars")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    base.unionByName(extra).unionByName(extra).write.parquet(str(tmp_path / "documents.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.count() > 20


def test_empty_tables(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
