"""Operators on one document at a time, against plain Python and the libraries."""

import hashlib
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tests.llm.fixtures import SF, awkward, documents, table
from tokenizers import Tokenizer

from vacantia.llm import _pretokens, _text, bpe, decontamination, quality_rules, secret_scan, token_files

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def oracle(sql, **tables):
    con = duckdb.connect()
    for name, rows in tables.items():
        con.register(name, pa.table(rows))
    return con.sql(sql)


def by_id(df):
    return {r[0]: r for r in df.collect()}


def test_quality_rules_match_sql(spark):
    rows = awkward() + [(i + 1000, t) for i, t in documents(60)]
    got = quality_rules.quality_report(table(spark, rows))
    want = oracle(quality_rules.ORACLE_SQL, documents={"doc_id": [i for i, _ in rows], "text": [t for _, t in rows]})
    cols = want.columns
    assert sorted(tuple(r[c] for c in cols) for r in got.collect()) == sorted(want.fetchall())


def test_quality_filter_keeps_columns_and_order_is_free(spark):
    df = table(spark)
    names = list(quality_rules.RULES)
    a, b = (quality_rules.quality_filter(df, order=o) for o in (names, names[::-1]))
    assert a.columns == df.columns
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    assert {r.doc_id for r in a.collect()} == {r.doc_id for r in quality_rules.quality_report(df).where("kept").collect()}
    assert quality_rules.quality_filter(df.limit(0), order=names).count() == 0
    assert sorted(quality_rules.plan_cascade(df)) == sorted(names)


def test_secrets(spark):
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    rows = awkward() + documents() + [(900, "password: token=abcdefghijklmnopq API_KEY='short' é secret:\x20\x20abcdefghijkl"), (900, None), (None, "passwd=abcdefghijklmnop"), (901, "ghp_" + "a1" * 20 + " eyJabcdefghij.eyJabcdefghij.sig")]
    got = secret_scan.secret_report(table(spark, rows)).collect()
    want = []
    for i, t in rows:
        t = t or ""
        s = [(m.start(), 0, m.end()) for m in assign.finditer(t) if len(m[2]) >= 12]
        s += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if m.end() - m.start() >= 18]
        s += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if m.end() - m.start() >= 16]
        text = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(s))
        want.append((i, *(sum(x[1] == k for x in s) for k in range(3)), hashlib.sha256(text.encode()).hexdigest()))
    assert sorted((r[:5] for r in got), key=str) == sorted(want, key=str)
    long = "-----BEGIN " + "LABEL " * 150_000 + "PRIVATE KEY-----"
    texts = {"pem": long, "assign": "token=" + "a" * 1_000_000, "access": "AKIA" + "B" * 1_000_000, "hex": "0a" * 500_000, "github": "ghp_" + "a" * 1_000_000, "slack": "xoxb-" + "1-" * 500_000,
             "google": ("AIza" + "x" * 35 + " ") * 25_000, "stripe": "sk_live_" + "a" * 1_000_000, "jwt": "eyJ" + "a" * 500_000 + ".eyJ" + "b" * 500_000 + ".c"}
    assert set(texts) == {r.kind for r in secret_scan.RULES}
    found = {r.doc_id: r.spans for r in secret_scan.secret_report(table(spark, list(enumerate(texts.values())))).collect()}
    for k, (kind, t) in enumerate(texts.items()):
        assert f"{kind}:0:{40 if kind == 'google' else len(t)}".replace(":0:40", ":0:39") in found[k].split(","), kind
    assert found[6].count("google") == 25_000
    kinds = {p.split(":")[0] for r in got if r.doc_id == 901 for p in r.spans.split(",")}
    assert {"github", "jwt"} <= kinds
    assert secret_scan.secret_report(table(spark, [])).count() == 0


def test_trigram_queries():
    assert secret_scan.trigram_query("[0-9a-f]+") is None
    assert secret_scan.trigram_query("AKIA[A-Z0-9]+") == ("and", ("aki", "kia"))
    assert secret_scan.trigram_query("(abcd|xyz)") == ("or", (("and", ("abc", "bcd")), "xyz"))
    assert secret_scan.trigram_query("abc?") is None  # "ab" has no trigram
    assert secret_scan.trigram_query("(ab)+cde") in ("cde", ("and", ("cde",)))


def test_pretokens_cut_every_kind_of_character(tokenizer):
    from tokenizers.pre_tokenizers import ByteLevel

    cutter = ByteLevel(add_prefix_space=False)
    for c in [*range(0x20, 0x3000, 7), 0x1C, 0x85, 0xA0, 0x2028, 0x3000, 0x1F600, 0x10FFFF]:
        x = f"a{chr(c)}1 {chr(c)}{chr(c)}.\n {chr(c)}'s"
        cp = np.frombuffer(x.encode("utf-32-le"), np.uint32)
        edge = np.zeros(len(cp) + 1, bool)
        edge[[0, -1]] = True
        assert _pretokens.starts_of(cp, edge).sum() == len(cutter.pre_tokenize_str(x)), hex(c)


def test_bpe_is_that_of_the_library(spark, tokenizer):
    rows = awkward() + [(i + 1000, t) for i, t in documents(80)] + [(500, "a" * 5000 + "1" * 700), (501, "'s'll ''t  'x \n\n 'd")]
    got = by_id(bpe.round_trip(table(spark, rows), PATH))
    for i, t in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids
        text = tokenizer.decode(ids, skip_special_tokens=False)
        assert got[i][1:] == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    back = bpe.decode_documents(bpe.encode_documents(table(spark), PATH), PATH)
    assert all((r.text or "") == r.decoded for r in back.collect())
    assert bpe.round_trip(table(spark, []), PATH).count() == 0


def test_simple8b_round_trip():
    r = np.random.default_rng(3)
    cases = [np.zeros(0), np.zeros(200), np.ones(61), r.integers(0, 50257, 5000), r.integers(0, 2, 3000), 2 ** r.integers(0, 60, 2000), np.array([2**60, 2**64 - 1, 5, 15 << 60, 15 << 60, 1], np.uint64)]
    for ids in map(lambda x: np.asarray(x).astype(np.uint64), cases):
        words, offsets = token_files.encode_blocks(ids, 128)
        assert (token_files.decode_words(words) == ids).all()
        for k in range(len(offsets) - 1):
            assert (token_files.decode_words(words[offsets[k] : offsets[k + 1]]) == ids[128 * k : 128 * (k + 1)]).all()


def test_token_files(spark, tokenizer):
    rows = awkward() + [(None, "no id"), (7, "same id")] + documents(40)[20:]
    df = table(spark, rows)
    manifest = _text.written(token_files.write_token_files(df, PATH, _text.shared_dir(spark)), "manifest")
    got = sorted(token_files.read_token_files(manifest).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i))
    start, seen = 0, []
    for r in got:
        assert r.start == start
        start += r.n_tokens
        seen.append((r.doc_id, r.n_tokens, r.ids_crc32))
    want = []
    for i, t in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [0]
        want.append((i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert sorted(seen, key=str) == sorted(want, key=str)
    empty = _text.written(token_files.write_token_files(table(spark, []), PATH, _text.shared_dir(spark)), "manifest")
    assert token_files.read_token_files(empty).count() == 0


def test_decontamination(spark):
    docs = awkward()
    items = [(1, docs[6][1]), (2, None), (3, ""), (4, "one TWO"), (5, "w1"), (5, "w1"), (6, " ".join(docs[12][1].split()[50:70])), (7, "-- !!"), (8, "ü")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = sorted(decontamination.brute_force(docs, items))
    got = decontamination.contamination_report(table(spark), bench)
    assert sorted(tuple(r) for r in got.collect()) == want
    few = decontamination.contamination_report(table(spark), bench, shard_words=20)  # several passes
    assert sorted(tuple(r) for r in few.collect()) == want
    shared = [(None, docs[6][1]), (None, "one two"), (None, None), (3, "x ü"), (3, "x ü"), (3, "x y"), (None, "one two")]
    few = decontamination.contamination_report(table(spark, shared), bench, shard_words=10)
    assert sorted(map(tuple, few.collect()), key=str) == sorted(decontamination.brute_force(shared, items), key=str)
    kept = decontamination.drop_contaminated(table(spark, shared), bench, shard_words=10)
    assert sorted(str(r.text) for r in kept.collect()) == ["None", "x y"]
    clean = decontamination.drop_contaminated(table(spark), bench)
    assert {r.doc_id for r in clean.collect()} == {w[0] for w in want if not w[5]} and clean.columns == table(spark).columns
    assert decontamination.contamination_report(table(spark), bench.limit(0)).where("contaminated").count() == 0
    assert decontamination.contamination_report(table(spark, []), bench).count() == 0


def test_decontamination_matches_sql(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    want = oracle(decontamination.ORACLE_SQL, documents=docs.toArrow().to_pydict(), benchmark=bench.toArrow().to_pydict())
    got = decontamination.contamination_report(docs, bench)
    assert sorted(tuple(r[c] for c in want.columns) for r in got.collect()) == sorted(want.fetchall())
