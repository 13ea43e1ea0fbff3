"""Long near-misses of every secret rule, tasks that run again, crowded signatures, and labelled documents that don't fit."""

import re
import time

import pyarrow as pa
from pyspark.sql import functions as F
from tests.llm.fixtures import table, words

from vacantia.llm import ngram_join, quality_model, secret_scan

N = 1_000_000
NEAR = {
    "assign": ["token" + " " * N, "token=" + " " * N + "!", "password'" * (N // 9), "secret = '" * (N // 10)],
    "access": ["AKIA" + "B" * 13 + " " + "AKIA " * (N // 5), "AKI" * (N // 3)],
    "hex": [("0123456789abcde" + "g") * (N // 16)],
    "github": ["ghp_" * (N // 4), ("ghp_" + "a" * 35 + " ") * (N // 40)],
    "slack": ["xoxb-" + "1 " * (N // 2), "xoxb-123456789 " * (N // 15)],
    "google": [("AIza" + "x" * 34 + " ") * (N // 39), "AIza" * 9 + " " + "AIz" * (N // 3)],
    "stripe": [("sk_live_" + "a" * 15 + " ") * (N // 24), "sk_live_" * (N // 8)],
    "jwt": [".eyJ " + "eyJ" * (N // 3), "eyJ" * (N // 3) + ".", ("eyJ" + "a" * 9 + ".") * (N // 13), "-eyJ" * (N // 4) + ".eyJ" + "a" * N],
    "pem": ["-----BEGIN " + "A" * N, "-----BEGIN " + "PRIVATE " * (N // 8), "-----BEGIN " * (N // 11)],
}


def test_long_near_misses_take_linear_time(spark):
    assert set(NEAR) == {r.kind for r in secret_scan.RULES}
    for k, (kind, texts) in enumerate(NEAR.items()):
        rules = [r for r in secret_scan.RULES if r.kind == kind]
        began = time.perf_counter()
        got = {r.doc_id: len(r.spans) for r in secret_scan.find_secrets(table(spark, list(enumerate(texts))), rules).collect()}
        assert time.perf_counter() - began < 20, kind  # the start of the jobs and several texts of a megabyte
        plain = [sum(len(m[rules[0].group]) >= rules[0].least for m in re.finditer(rules[0].regex, t)) for t in texts if kind != "jwt"]
        assert kind == "jwt" or [got[i] for i in range(len(texts))] == plain, kind


def test_jwt_begins_at_the_start_of_a_run(spark):
    token = "eyJ" + "a" * 9 + ".eyJ" + "b" * 9 + ".sig"
    texts = [token, " " + token, "x" + token, f"{token} {token}", f"{token}.{token}", f"é{token}!"]
    got = {r.doc_id: [(s.start, s.end) for s in r.spans] for r in secret_scan.find_secrets(table(spark, list(enumerate(texts))), [r for r in secret_scan.RULES if r.kind == "jwt"]).collect()}
    n = len(token)
    assert got == {0: [(0, n)], 1: [(1, 1 + n)], 2: [], 3: [(0, n), (n + 1, 2 * n + 1)], 4: [(0, n), (n + 1, 2 * n + 1)], 5: [(1, n + 1)]}


def test_a_task_that_runs_again_packs_the_same_rows():
    base = words(1, 40)
    texts = [" ".join([*base[:k % 40], f"x{k}", *base[k % 40 :]]) for k in range(300)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    runs = [pa.Table.from_batches(ngram_join._packer(64)([batch])) for _ in range(2)]
    assert runs[0].equals(runs[1])
    assert min(runs[0].column("bucket").to_pylist()) < 0  # there are hot signatures


def test_crowded_signatures_in_portions(spark, monkeypatch):
    base = words(3, 60)
    rows = [(k, " ".join([*base[: k % 60], f"y{k}", *base[k % 60 :]])) for k in range(150)] + [(1000 + k, " ".join(words(k, 30))) for k in range(60)]
    want = sorted(ngram_join.brute_force(rows))
    for met, row in ((200, 1 << 16), (4_000_000, 3)):
        monkeypatch.setattr(ngram_join, "MET", met)
        monkeypatch.setattr(ngram_join, "ROW", row)
        assert sorted(tuple(r) for r in ngram_join.link_documents(table(spark, rows)).collect()) == want


def test_a_labelled_document_that_does_not_fit_is_passed_over(spark):
    ids = [r.id for r in spark.range(60).where(~quality_model.held_out("id")).collect()]
    first = spark.createDataFrame([(i,) for i in ids], "doc_id long").orderBy(F.xxhash64("doc_id"), "doc_id").first()[0]
    texts = [(i, "x " * (quality_model.PASSAGE * 40) if i == first else f"good words {i}" if i % 2 else f"bad # {i}") for i in ids]
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, quality int")
    assert quality_model.fit_quality(table(spark, texts), labels, passages=60).fitted
