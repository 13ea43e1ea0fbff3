"""Operators over the whole corpus, against brute force."""

import hashlib

import duckdb
import numpy as np
import pyarrow as pa
from tests.llm.fixtures import SF, awkward, documents, table, words

from vacantia.llm import _text, chat_format, line_dedup, ngram_join, quality_model, warc


def test_ngram_join(spark):
    rows = awkward() + documents()[:120]
    rows = list({i + 1000 * (k >= len(awkward())): (i + 1000 * (k >= len(awkward())), t) for k, (i, t) in enumerate(rows)}.values())
    got = ngram_join.link_documents(table(spark, rows))
    assert sorted(tuple(r) for r in got.collect()) == sorted(ngram_join.brute_force(rows))
    assert ngram_join.link_documents(table(spark, [])).count() == 0


def test_ngram_join_of_many_sizes_and_distances(spark):
    rng, rows = np.random.default_rng(5), []
    for k in range(60):
        base = words(k, int(rng.integers(1, 90)), 60)
        for _ in range(4):
            t = list(base)
            for _ in range(int(rng.integers(0, 4))):
                t[int(rng.integers(0, len(t)))] = "new" + str(rng.integers(0, 3))
            rows.append((len(rows), " ".join(t[: len(t) - int(rng.integers(0, 4)) or 1])))
    got = ngram_join.link_documents(table(spark, rows))
    assert sorted(tuple(r) for r in got.collect()) == sorted(ngram_join.brute_force(rows))


def test_linked_sets_share_a_signature():
    rng = np.random.default_rng(8)
    for size in [*range(1, 60), 100, 300, 1000]:
        for _ in range(3):
            x = rng.integers(0, 2**63, size, dtype=np.uint64)
            out = int(rng.integers(0, size // 4 + 1))
            y = np.unique(np.concatenate([x[out:], rng.integers(0, 2**63, int(rng.integers(0, size // 4 + 1)), dtype=np.uint64)]))
            x = np.unique(x)
            inter = np.intersect1d(x, y).size
            if len(y) and 4 * inter >= 3 * (len(x) + len(y) - inter):
                s, row = ngram_join.signatures(np.concatenate([x, y]), np.array([0, len(x), len(x) + len(y)]))
                assert set(s[row == 0]) & set(s[row == 1]), size


def test_signatures_follow_the_set_and_unrelated_sets_share_none():
    rng = np.random.default_rng(4)
    for size in (1, 7, 30, 100, 300, 1000, 3000, 10_000):
        x = np.sort(rng.integers(0, 2**63, size, dtype=np.uint64))
        s, _ = ngram_join.signatures(x, np.array([0, size]))
        assert len(s) <= 1.7 * size + 12, (size, len(s))
    for size in (3, 7, 14, 35):
        h = np.sort(rng.integers(0, 2**63, (20_000, size), dtype=np.uint64), axis=1).reshape(-1)
        s, _ = ngram_join.signatures(h, np.arange(20_001) * size)
        _, n = np.unique(s, return_counts=True)
        assert (n > 1).sum() == 0, size


def near_copies_and_passages() -> list[tuple[int | None, str]]:
    """A hot group of near copies, a chain of revisions, and unrelated texts with one passage; repeated and null ids."""
    base, rows = words(77, 60, 5000), []
    for k in range(60):
        t = list(base)
        t[(k * 7) % 60] = f"new{k % 9}"
        rows.append((100 + k, " ".join(t)))
    chain = words(78, 80, 5000)
    for k in range(30):
        chain = [*chain[2:], f"next{k}", f"after{k}"]
        rows.append((300 - k, " ".join(chain)))
    passage = words(79, 30, 5000)
    rows += [(400 + k, " ".join([*passage, *words(800 + k, 30, 5000)])) for k in range(40)]
    rows += [(None, rows[3][1]), (None, rows[65][1] + " end"), (None, "alone and without an id here"), (None, "alone and without an id here"), (411, "one id for two texts of some words"), (411, rows[95][1]), (101, rows[1][1]), (101, rows[1][1])]
    return rows


def test_ngram_join_of_large_groups(spark, monkeypatch):
    rows = near_copies_and_passages()
    monkeypatch.setattr(ngram_join, "TILE", 8)
    monkeypatch.setattr(ngram_join, "HOT", 4)
    key = lambda r: str(tuple(r))
    got = ngram_join.link_documents(table(spark, rows).repartition(3))
    assert sorted(map(tuple, got.collect()), key=key) == sorted(ngram_join.brute_force(rows), key=key)
    kept = ngram_join.keep_one(table(spark, rows)).collect()
    # one row of each component, of which two have the id 411
    assert len(kept) == len({c if c is not None else t for (_, t), (_, _, c) in zip(rows, ngram_join.brute_force(rows))}) + 1
    assert sum(r.doc_id is None for r in kept) == 1 and sum(r.doc_id == 100 for r in kept) == 1


def test_links_of_a_group_are_linear_in_its_members(spark, monkeypatch):
    rows = near_copies_and_passages()[:60]
    monkeypatch.setattr(ngram_join, "TILE", 8)
    made: dict[bool, int] = {}
    compare = ngram_join._compare

    def counted(tiles, exact, buckets):
        out = _text.written(compare(tiles, exact, buckets), "made")
        made[exact] = max(out.count(), made.get(exact, 0))
        return out

    monkeypatch.setattr(ngram_join, "_compare", counted)
    assert {r.component_id for r in ngram_join.link_documents(table(spark, rows)).collect()} == {100}
    # 8 blocks of a cluster, some hundred groups with other members each
    assert made[True] <= 3 * len(rows) and made[False] <= 10 * len(rows)


def test_components_of_a_long_chain(spark):
    ids = np.random.default_rng(1).permutation(1000).tolist()
    falling = [1000, *range(1999, 1000, -1)]  # the smallest id beside the largest
    pairs = [*zip(ids, ids[1:]), *zip(falling, falling[1:])]
    got = ngram_join.components(spark.createDataFrame(pairs, "a long, b long"))
    assert sorted(map(tuple, got.collect())) == [(i, i // 1000 * 1000) for i in range(2000)]


def test_keep_one(spark):
    kept = ngram_join.keep_one(table(spark))
    want = {i for i, _, c in ngram_join.brute_force(awkward()) if i == c}
    assert {r.doc_id for r in kept.collect()} == want and kept.columns == table(spark).columns


def test_line_dedup(spark):
    rows = awkward() + [(i + 1000, t) for i, t in documents()[:80]]
    got = line_dedup.line_report(table(spark, rows))
    want = sorted(line_dedup.brute_force(rows))
    assert sorted(tuple(r) for r in got.collect()) == want
    kept = line_dedup.dedup_lines(table(spark, rows), drop_empty=False)
    assert kept.columns == table(spark).columns
    texts, gone = dict(rows), {w[0]: set(map(int, w[3].split(","))) if w[3] else set() for w in want}
    for r in kept.collect():
        lines = (texts[r.doc_id] or "").split("\n")
        assert (r.text or "") == "\n".join(x for k, x in enumerate(lines) if k not in gone[r.doc_id])
    assert line_dedup.line_report(table(spark, [])).count() == 0
    # rows without an id come last and keep what is in no earlier row
    odd = line_dedup.dedup_lines(table(spark, [(None, "a b\na b\nonly here"), (1, "a b"), (None, "a b\nelse where\nand more")]))
    assert sorted(r.text for r in odd.collect()) == ["a b", "else where\nand more", "only here"]


def test_repeat_search_finds_the_same(spark):
    docs = table(spark, [(i, t) for i, t in documents()]).select("doc_id", "text")
    rarity = spark.sparkContext.broadcast(line_dedup.word_rarity(docs))
    classes = _text.written(line_dedup._class_rows(docs, rarity, 16), "classes")
    classes = classes.where("bucket >= 0")
    found = _text.written(line_dedup._found(line_dedup._entries(classes, 16)), "found")
    pairs = found.where("other_doc IS NOT NULL")
    full = set(map(tuple, line_dedup._verified(docs, pairs).collect()))
    # as if a third of the lines were open in each of their ranges
    some = pairs.where("pmod(hash(doc, line), 3) = 0").select("doc", "line", "range", "low", "high").distinct()
    tokens = [(int(r), int(t)) for c in classes.collect() for r, t in zip(*line_dedup._words_of(bytes(c.prefix), 16))]
    only = spark.sparkContext.broadcast(line_dedup._bitmap(spark.createDataFrame(tokens, "doc long, line int")))
    again = line_dedup._found(line_dedup._entries(line_dedup._narrow(classes, 16, only), 16, None, only), some)
    assert set(map(tuple, line_dedup._verified(docs, again).collect())) == full & {(r.doc, r.line) for r in some.collect()}
    big = line_dedup.FILTER_LINES
    line_dedup.FILTER_LINES = 1  # the join in place of the bitmap
    try:
        assert set(map(tuple, line_dedup._verified(docs, pairs).collect())) == full
    finally:
        line_dedup.FILTER_LINES = big


def test_lines_of_one_template(spark, monkeypatch):
    rows = [(k, f"thread started by user{k * 7919 % 1500} in the general discussion forum\nhello {words(k, 9)[0]}") for k in range(1500)]
    docs = table(spark, rows)
    rarity = spark.sparkContext.broadcast(line_dedup.word_rarity(docs))
    classes = _text.written(line_dedup._class_rows(docs, rarity, 32), "classes")
    classes = classes.where("bucket >= 0")
    whole = {(r.doc, r.line) for r in line_dedup._found(line_dedup._entries(classes, 32)).collect()}
    monkeypatch.setattr(line_dedup, "PAIRS", 6000)
    monkeypatch.setattr(line_dedup, "ENTRIES", 1000)
    crowded = line_dedup._crowded(classes, 32)
    assert max(crowded.values()) > 2
    # every pair of blocks meets, and a task's pairs are bounded by lines and not by their square
    tiled = line_dedup._found(line_dedup._entries(classes, 32, crowded))
    assert {(r.doc, r.line) for r in tiled.collect()} == whole
    tasks = sum(b * (b + 1) // 2 for b in crowded.values()) + 64
    assert tiled.where("other_doc IS NOT NULL").count() <= tasks * 6000
    got = line_dedup.line_report(docs)
    assert sorted(tuple(r) for r in got.collect()) == sorted(line_dedup.brute_force(rows))


def test_open_lines_are_searched_for_all_of_theirs(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "BEST", 1)
    base = words(5, 40, 3000)
    rows = [(k, " ".join([*base[:30 - k % 11], *words(50 + k, 10, 3000)])) for k in range(120)] + [(200, " ".join([*base[:25], *words(51, 9, 3000)]))]
    got = line_dedup.line_report(table(spark, rows))
    assert sorted(tuple(r) for r in got.collect()) == sorted(line_dedup.brute_force(rows))


def test_best_pairs_of_parts_are_those_of_all():
    rng = np.random.default_rng(3)
    i, j, apart = rng.integers(0, 40, 20_000), np.arange(20_000), rng.integers(100, 1000, 20_000)
    held = [np.zeros(0, np.int64)] * 3
    for at in range(0, 20_000, 500):
        held = line_dedup._best(*(np.append(a, b[at : at + 500]) for a, b in zip(held, (i, j, apart))), 600)[:3]
        assert len(held[0]) <= 40 * 128 * line_dedup.BEST
    assert all((a == b).all() for a, b in zip(held, line_dedup._best(i, j, apart, 600)))


def test_packed_records_round_trip():
    rows = np.zeros(50, line_dedup.ENTRY)
    r = np.random.default_rng(1)
    for c in rows.dtype.names:
        rows[c] = np.sort(r.integers(0, 2**31, 50)) - (2**30 if c == "doc" else 0)
    assert (line_dedup.unpack([line_dedup.pack(rows[:20]), line_dedup.pack(rows[20:])], line_dedup.ENTRY) == rows).all()


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, rank string, start int")


def test_chat_format(spark):
    odd = r"</s>[INST] ok [/INST] \ \\ [\INST] <</s>"
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", odd), (2, 0, "user", "hi"), (2, 1, "assistant", "other"), (2, 2, "user", None), (3, 0, "user", "hi"), (4, 0, "user", "hi"), (4, 1, "assistant", odd),
            (5, None, None, None), (5, 1, "assistant", ""), (6, 0, odd, "x"), (7, 0, "assistant", "a"), (7, 0, "assistant", "a"), (None, 0, "user", "n"), (8, 0, "user", "é日" * 3000)]
    out = chat_format.format_conversations(conversations(spark, rows))
    got = {r.conv_id: r for r in chat_format.read_conversations(out).collect()}
    want: dict = {}
    for c, t, role, text in sorted(rows, key=lambda r: (str(r[0]), r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        want.setdefault(c, []).append((role or "", text or ""))
    assert {c: [(t.role, t.text) for t in r.turns] for c, r in got.items()} == want
    assert all(r.loss == "".join(t for role, t in want[c] if role == "assistant") for c, r in got.items())
    stream = sorted(out["stream"].collect(), key=lambda r: r.start)
    assert stream[0].start == 0 and all(a.end == b.start for a, b in zip(stream, stream[1:]))
    assert sum(r.formatted.startswith("[INST]user[/INST]hi") for r in stream) == 1  # shared turns once
    text = "".join(r.formatted for r in stream)
    for r in stream:  # what a node attends to is the conversation before it
        before = "".join(text[i.start : i.end] for i in r.ancestors)
        assert len(before) == r.position and len(r.formatted) == r.end - r.start
    assert chat_format.read_conversations(chat_format.format_conversations(conversations(spark, []))).count() == 0


def test_chat_format_matches_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{SF}/conversations.parquet')")
    want = con.sql(chat_format.ORACLE_SQL)
    got = chat_format.op9_chat_format(spark, SF)
    assert sorted(tuple(r[c] for c in want.columns) for r in got.collect()) == sorted(want.fetchall())


def test_warc(spark):
    html = [(1, "http://a.com/x", "<p>one</p>"), (2, "https://www.b.org:8080/y?q=1", "<p>one</p>"), (3, None, None), (4, "http://a.com/x", "é" * 9000), (5, "not a url", ""), (2, "http://c", "<p>one</p>"), (None, "http://d\n", "only"), (6, "http://a.com/\tz", "z")]
    pages = spark.createDataFrame([(*r, "k", 1) for r in html], "page_id long, url string, html string, key string, last int")
    captures = warc.write_archives(pages, _text.shared_dir(spark))
    upper = warc.write_index(captures, _text.shared_dir(spark), block=2, parts=3)
    got = warc.read_records(warc.look_up(captures.select("key"), upper), payloads=True).collect()
    by_text: dict = {}
    for page, _, text in html:
        by_text.setdefault(text or "", []).append(page)
    assert len(got) == len(html)
    for r in got:
        last = max((p for p in by_text[next(t or "" for p, _, t in html if p == r.page_id)] if p is not None), default=None)
        text = next(t or "" for p, _, t in html if p == r.page_id)
        assert (r.payload_bytes, r.record_type, r.refers_to) == (len(text.encode()), "response" if r.page_id == last or r.page_id is None else "revisit", None if r.page_id in (last, None) else last)
        assert r.payload_digest == warc.digest_of(text.encode()) and bytes(r.payload) == (text.encode() if r.record_type == "response" else b"")
    some = captures.where("key LIKE 'com,a)%'").select("key")
    assert warc.look_up(some, upper).count() == some.count() == 3
    assert warc.look_up(spark.createDataFrame([("zz,none)/ 1",)], "key string"), upper).count() == 0
    empty = warc.write_archives(pages.limit(0), _text.shared_dir(spark))
    assert warc.look_up(empty.select("key"), warc.write_index(empty, _text.shared_dir(spark))).count() == 0


def test_warc_keys_are_sorted_as_searched(spark):
    urls = ["http://[bad\tx", "http://[bad!x", "http://[bad\nx", "http://[bad#x", "http://[bad\\x", "http://[bad]x"]
    pages = spark.createDataFrame([(k, u, f"page {k}") for k, u in enumerate(urls)], "page_id long, url string, html string")
    captures = warc.write_archives(pages, _text.shared_dir(spark))
    upper = warc.write_index(captures, _text.shared_dir(spark), block=1, parts=1)
    got = warc.read_records(warc.look_up(captures.select("key"), upper)).collect()
    assert sorted(r.page_id for r in got) == list(range(len(urls)))


def test_warc_keys_sort_by_reversed_host():
    assert warc.url_key("http://www.Example.com:80/a?b") == "com,example)/a?b"
    assert warc.url_key("https://x.y.org:8443") == "org,y,x:8443)/"
    assert warc.url_key(None) == ")/"


def test_quality_model(spark):
    docs = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet")
    labels = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/labels.parquet")
    model = quality_model.fit_quality(docs, labels)
    assert not quality_model.fit_quality(docs, labels, passages=1).fitted
    got = quality_model.score_quality(docs, model).toPandas().merge(labels.toPandas(), on="doc_id")
    far = got[got.held_out]
    assert len(far) > 50 and (far.predicted == far.quality).mean() > 0.9
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.5)).all()
    odd = quality_model.score_quality(table(spark), model).collect()
    assert len(odd) == len(awkward()) and all(0 <= r.score <= 1 for r in odd)
    none = quality_model.fit_quality(docs, labels.limit(0))
    assert {r.score for r in quality_model.score_quality(table(spark), none).collect()} == {0.5}
    assert quality_model.score_quality(table(spark, []), model).count() == 0


def test_gradients_are_those_of_the_loss():
    r = np.random.default_rng(2)
    word = np.array([0, 3, 3, 8, 12, 20, 21, 25, 30, 40])
    bags = quality_model.Bags(r.normal(size=(9, quality_model.FEATURES)), np.array([0, 2, 5, 9]), r.integers(0, 5, 40), r.uniform(0.1, 0.5, 40), word)
    y, w = np.array([1.0, 0, 1]), np.array([0.2, 0.3, 0.5])
    m = quality_model.Model(np.zeros(quality_model.FEATURES), np.ones(quality_model.FEATURES), 0.5)

    def loss():
        p = m.forward(bags)["score"]
        return -(w * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum() / w.sum()

    grads = m.gradients(bags, y, w)
    for k, g in grads.items():
        at = (3, 2) if k == "E" else tuple(r.integers(0, n) for n in m.p[k].shape)
        old = m.p[k][at]
        m.p[k][at] = old + 1e-6
        up = loss()
        m.p[k][at] = old - 1e-6
        down = loss()
        m.p[k][at] = old
        assert abs((up - down) / 2e-6 - g[at]) < 1e-6, k


def plain_score(model, text: str | None) -> float:
    """The score of one document, passage by passage and word by word."""
    import math
    import re

    data, hs, attention = (text or "").encode(), [], []
    words = [(m.start(), m[0]) for m in re.finditer(rb"[^\x20\x09-\x0D]+", data)]
    for begin in range(0, max(len(data), 1), quality_model.PASSAGE):
        part = data[begin : begin + quality_model.PASSAGE]
        size, own = max(len(part), 1), [w for at, w in words if begin <= at < begin + quality_model.PASSAGE]
        n, lower = max(len(own), 1), [re.sub(rb"[A-Z]", lambda m: m[0].lower(), w) for w in own]
        classes = (rb"[A-Z]", rb"[a-z]", rb"[0-9]", rb"[\x20\x09-\x0D]", rb"\n", rb"[.,]", rb"[!?]", rb"[#*$%&|<>@^~={}\[\]\\_+/]", rb"""["'():;]""", rb"[\x80-\xff]")
        mean = sum(map(len, own)) / n
        spread = math.sqrt(max(sum(len(w) ** 2 for w in own) / n - mean**2, 0))
        grams = {tuple(lower[k : k + 3]) for k in range(len(own) - 2)}
        x = [len(re.findall(c, part)) / size for c in classes]
        x += [min(mean, 40) / 10, min(spread, 40) / 10, math.log1p(len(own)) / 5, len(set(lower)) / n, len(grams) / (len(own) - 2) if len(own) > 2 else 1.0]
        x += [sum(bool(re.search(rb"[A-Za-z\x80-\xff]", w)) for w in own) / n, math.log1p(size) / 8, math.log1p(len(data)) / 10, sum(len(w) > 20 for w in own) / n, float(not own)]
        content = np.zeros(quality_model.CONTENT)
        for w in own:
            b = np.frombuffer(w, np.uint8)
            content += model.p["E"][int(_text.span_hashes(_text.prefix_sums(_text.FOLDED_VALUES[b]), np.array([0]), np.array([len(b)]))[0]) >> 52] / n
        h = np.tanh(np.concatenate([(np.array(x) - model.mean) / model.scale, content]) @ model.p["W"] + model.p["b"])
        hs.append(h)
        attention.append(float(model.p["w"] @ (np.tanh(h @ model.p["V"]) / (1 + np.exp(-(h @ model.p["U"]))))))
    a = np.exp(np.array(attention) - max(attention))
    return 1 / (1 + math.exp(-float((a / a.sum()) @ np.array(hs) @ model.p["c"] + model.p["d"][0])))


def test_scores_are_those_of_plain_code(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = quality_model.fit_quality(docs.union(docs.limit(3)), labels)  # repeated rows count once
    again = quality_model.fit_quality(docs, labels)
    assert model.fitted and all((again.p[k] == v).all() for k, v in model.p.items())
    texts = dict(documents(150) + [(-i, t) for i, t in awkward()] + [(-90, " ".join(words(3, 3000)))])
    got = quality_model.score_quality(table(spark, list(texts.items())), model).collect()
    assert len(got) == len(texts) and all(abs(r.score - plain_score(model, texts[r.doc_id])) < 1e-6 for r in got)


def test_held_out_rows_never_teach(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    import zlib

    want = {r.doc_id for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 3 == 1}
    assert {r.doc_id for r in labels.where(quality_model.held_out()).collect()} == want


def test_pipeline(spark, tmp_path):
    import corpus_pipeline
    from tests.llm.test_text_operators import PATH
    from tokenizers import Tokenizer

    from vacantia.llm import decontamination, quality_rules

    rows = [(i, t) for i, t in documents()]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    kept = {r.doc_id for r in quality_rules.quality_report(table(spark, rows), order=list(quality_rules.RULES)).where("kept").collect()}
    rows = [(i, t) for i, t in rows if i in kept]
    gone = {w[0]: set(map(int, w[3].split(","))) if w[3] else set() for w in line_dedup.brute_force(rows)}
    rows = [(i, "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[i])) for i, t in rows]
    rows = [(i, t) for i, t in rows if not gone[i] or t.split()]
    alone = {i for i, _, c in ngram_join.brute_force(rows) if i == c}
    rows = [(i, t) for i, t in rows if i in alone]
    clean = {w[0] for w in decontamination.brute_force(rows, items) if not w[5]}
    tk = Tokenizer.from_file(PATH)
    want = {i: hashlib.sha256(np.array(tk.encode(t, add_special_tokens=False).ids, "<u4").tobytes()).hexdigest() for i, t in rows if i in clean}
    assert {i: r.ids_sha256 for i, r in got.items()} == want
    assert all(r.decoded_sha256 == hashlib.sha256(dict(rows)[i].encode()).hexdigest() for i, r in got.items())


def test_pipeline_of_awkward_rows(spark, tmp_path):
    import corpus_pipeline

    a, b, c, d, e = (words(k, n, 3000) for k, n in ((71, 90), (72, 80), (73, 30_000), (74, 120), (75, 70)))
    cut = lambda w, k: "\n".join(" ".join(w[i : i + k]) for i in range(0, len(w), k))
    item = spark.read.parquet(f"{SF}/benchmark.parquet").where("length(text) > 80").orderBy("item_id").first().text
    rows = [
        (1, None), (2, ""), (None, None), (4, " \n\t "), (3, " ".join(a)), (3, " ".join(a)), (5, " ".join(a)), (None, " ".join(a)),
        (None, " ".join(b)), (9, " ".join(c)), (20, cut(d, 12)), (21, cut(d, 120)), (None, cut(d, 60)), (30, " ".join(e) + "\n" + item),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long, n long, label long, row long, doc long, line long, t long, h string, a int, b int, rules string"

    def run(name: str, docs: list, benchmark: list) -> list:
        folder = f"{tmp_path}/{name}"
        full = [(i, x, "en", "s", len(x or ""), 1, 2, 3, 4, 5, 6, "h", 7, 8, "r") for i, x in docs]
        spark.createDataFrame(full, schema).write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame(benchmark, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
        return corpus_pipeline.run(spark, folder).collect()

    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    found = sorted(((r.doc_id, r.decoded_sha256) for r in run("rows", rows, [(1, item), (None, None), (2, "")])), key=repr)
    assert found == sorted([(3, digest(" ".join(a))), (None, digest(" ".join(b))), (9, digest(" ".join(c))), (20, digest(cut(d, 12)))], key=repr)
    assert run("empty", [], [(1, item)]) == []
    assert {r.doc_id for r in run("nothing to find", [r for r in rows if r[0] in (9, 30)], [])} == {9, 30}
