"""Quality rules, line dedup, sharding: brute force and odd inputs."""

import collections
import hashlib
import math
import random
import re
import struct
import zlib

import numpy as np
import xxhash
from benchlake.llm import line_dedup, quality, sharding
from conftest import SF, words
from pyspark.sql import functions as F

SPACE = " \t\n\x0b\x0c\r"


def brute_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if x.strip(SPACE)]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    twice = {w for w, n in collections.Counter(windows).items() if n > 1}
    covered = {i + k for i, w in enumerate(windows) if w in twice for k in range(3)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def counts(df):
    return sorted((str(r.doc_id), (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words), r.base_failed, r.kept)
                  for r in df.collect())


def test_quality_counts_match_brute_force(spark, odd_rows, odd_docs):
    labels = spark.createDataFrame([(1, 1, 0), (3, 1, 0), (None, 1, 0), (3, 1, 1)], "doc_id long, quality int, toxic int")
    got = counts(quality.judge(odd_docs, labels))
    want = sorted((str(i), brute_counts(t)) for i, t in odd_rows)
    assert [g[:2] for g in got] == want
    for _, (n, *_, repeat), failed, kept in got:
        assert failed == (n < 50 or 100 * repeat > 50 * n) and not (failed and kept)
    repeated = spark.createDataFrame([(1, "x y z " * 40), (2, "a b\na b\n" * 3)], "doc_id long, text string")
    assert [g[1] for g in counts(quality.judge(repeated, labels))] == [brute_counts("x y z " * 40), brute_counts("a b\na b\n" * 3)]


def test_quality_without_labels_or_documents(spark, odd_docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert all(r.kept == (not r.base_failed) for r in quality.judge(odd_docs, none).collect())  # no target: all ratios 0
    assert quality.judge(no_docs, none).count() == 0


def test_quality_rejects_labelled_junk_and_keeps_clean(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    judged = quality.judge(docs, labels).where("not base_failed").join(labels, "doc_id")
    by = {r[0]: r[1:] for r in judged.selectExpr("quality", "cast(kept as int) k").groupBy("quality").agg(
        F.count("k"), F.sum("k")).collect()}
    assert by[1][1] >= 0.995 * by[1][0]
    assert by[0][1] <= 0.1 * by[0][0]


def brute_lines(rows):
    key = lambda x: re.sub("[A-Z]", lambda m: m[0].lower(), x.strip(SPACE))
    low = -(1 << 70)
    held = collections.defaultdict(set)
    for i, t in rows:
        for x in (t or "").split("\n"):
            held[key(x)].add(low if i is None else i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 20 or len(held[key(x)]) < 3 or max(held[key(x)]) == (low if i is None else i)]
        out.append((str(i), len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out)


def test_line_dedup_matches_brute_force_on_both_ways(odd_rows, odd_docs, no_docs):
    want = brute_lines(odd_rows)
    assert sum(w[2] for w in want) > 3
    for bound in (line_dedup.MAX_ARRAY_BYTES, 0):
        got = line_dedup.dedup_lines(odd_docs, max_array_bytes=bound).collect()
        assert sorted((str(r.doc_id), r.n_lines, r.n_dropped, r.kept) for r in got) == want
    assert line_dedup.dedup_lines(no_docs).count() == 0


def test_line_dedup_probes_travel_to_the_shards(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", 5)
    monkeypatch.setattr(line_dedup, "PROBES", 40)
    hot = "a line that a third of all documents hold"
    rows = [(None if i % 50 == 0 else i // 2 if i < 60 else i, "\n".join([hot] * (i % 3 == 0) + [
        f"a shared line of some length, number {(i * k) % 37}" for k in (1, 2, 3)] + [f"a line of its own, number {i}"])) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    near, far = (sorted(map(repr, line_dedup.dedup_lines(docs, max_array_bytes=bound).collect())) for bound in (64 << 20, 0))
    assert near == far and any("n_dropped=0" not in r for r in far) and len(far) == 300


def test_line_dedup_of_a_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = brute_lines([(r.doc_id, r.text) for r in docs.collect()])
    got = line_dedup.dedup_lines(docs).collect()
    assert sorted((str(r.doc_id), r.n_lines, r.n_dropped, r.kept) for r in got) == want


def test_perfect_hash_is_minimal_and_turns_others_away():
    import numpy as np

    rng = np.random.default_rng(1)
    first, second = (rng.integers(0, 1 << 64, 5000, dtype=np.uint64) for _ in range(2))
    first[:4] = first[0]  # equal halves settle by the other half
    levels = line_dedup.build_levels(first, second)
    row = {"shard": 0, "levels": [np.packbits(x).tobytes() for x in levels], "sizes": [len(x) for x in levels],
           **{k: bytes(8 * 5000) for k in ("fingerprints", "counts", "holders")}}
    table = line_dedup.Shards([row], 1)
    slots = table.slots(first, second, check=False)
    assert sorted(slots) == list(range(5000))
    table.fingerprints = np.zeros(5000, np.uint64)
    table.fingerprints[slots] = second
    assert (table.slots(first, second) == slots).all()
    assert (table.slots(*(rng.integers(0, 1 << 64, 5000, dtype=np.uint64) for _ in range(2))) == -1).all()


def jump(key, n):
    """Jump consistent hash as published (Lamping and Veach)."""
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / ((key >> 33) + 1)))
    return b


def test_sharding_matches_the_published_function(odd_rows, odd_docs, no_docs):
    got = sharding.shard(odd_docs, 24).collect()
    texts = collections.Counter((str(i), zlib.crc32((t or "").encode()), len((t or "").encode()) + 8) for i, t in odd_rows)
    assert collections.Counter((str(r.doc_id), r.text_crc32, r.size) for r in got) == texts
    slots = collections.defaultdict(list)
    for r in got:
        key = int(hashlib.md5(("" if r.doc_id is None else str(r.doc_id)).encode()).hexdigest()[:16], 16)
        assert (r.shard, r.grown_shard, r.law) == (jump(key, 24), jump(key, 25), "key")
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.shard(no_docs).count() == 0


def test_growth_moves_rows_into_the_new_shard_only(spark):
    ids = spark.range(20_000).selectExpr("id as doc_id", "'x' as text")
    rows = sharding.shard(ids, 9).collect()
    moved = [r for r in rows if r.grown_shard != r.shard]
    assert {r.grown_shard for r in moved} == {9} and abs(len(moved) - 2000) < 300
    sizes = collections.Counter(r.shard for r in rows)
    assert len(sizes) == 9 and max(sizes.values()) < 1.15 * 20_000 / 9


def hashed(*words):
    """Spark's 64-bit hash of strings, one after the other."""
    seed = 42
    for w in words:
        seed = xxhash.xxh64_intdigest(w.encode(), seed)
    return seed - (1 << 64) if seed >> 63 else seed


def brute_scores(rows, good, buckets, smoothing=1.0):
    """Score of every document, by the trusted documents of the other fold."""
    fold = {d: (lambda h: (h - (1 << 64) if h >> 63 else h) % 2)(xxhash.xxh64_intdigest(struct.pack("<q", d), 42)) for d, _ in rows if d is not None}
    grams = []
    for _, text in rows:
        w = re.findall("[^\\x20\\x09-\\x0D]+", text or "")
        grams.append([hashed(x) % buckets for x in w] + [hashed(x, y) % buckets for x, y in zip(w, w[1:], strict=False)])
    raw = collections.Counter(c for g in grams for c in g)
    target = [collections.Counter(c for (d, _), g in zip(rows, grams, strict=True) if d in good and fold[d] != f for c in g) for f in (0, 1)]
    out = []
    for (d, _), own in zip(rows, grams, strict=True):
        t = target[fold.get(d, 0)]
        t_all, r_all = t.total() + smoothing * buckets, raw.total() + smoothing * buckets
        out.append(sum(math.log((t[c] + smoothing) / t_all) - math.log((raw[c] + smoothing) / r_all) for c in own) / len(own) if own else None)
    return out


def test_scores_and_verdicts_match_brute_force(spark):
    rng = random.Random(21)
    rows = [(i, words(rng, rng.randint(40, 90)) if i % 4 else " ".join(f"junk{rng.randint(0, 60)}" for _ in range(70))) for i in range(80)]
    rows += [(None, rows[1][1]), (200, None), (201, "x y z " * 40)]
    labels = [(i, int(i % 4 > 0), int(i % 10 == 1), 1) for i in range(0, 60)] + [(None, 1, 0, 1), (999, 1, 0, 1), (5, 1, 0, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int, kept int")
    good = {d for d, q, t, _ in labels if q == 1 and t == 0 and d is not None}
    want = brute_scores(rows, good, 1 << 14)
    got = {(r.doc_id, r.n_words): r for r in quality.judge(df, lab, buckets=1 << 14).collect()}
    passed = []
    for (d, text), score in zip(rows, want, strict=True):
        r = got[d, len((text or "").split())]
        assert (r.score is None and score is None) or abs(r.score - score) < 1e-5
        if d in good and not r.base_failed:
            passed.append(score)
    least = float(np.quantile(passed, quality.LOSS))
    for (d, text), score in zip(rows, want, strict=True):
        r = got[d, len((text or "").split())]
        assert r.kept == (not r.base_failed and score >= least - 1e-5)
        assert d is None or d % 4 or not r.kept  # junk goes, with or without a label
    others = [r.kept for (d, _), r in got.items() if d is not None and d % 4 and not r.base_failed]
    assert sum(others) >= 0.9 * len(others)  # a threshold from 40 trusted documents


def test_documents_whose_labels_are_hidden_are_kept_alike(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    good = labels.where("quality = 1 and toxic = 0")
    shown = good.where("pmod(xxhash64(doc_id, 7), 2) = 0").withColumn("shown", F.lit(True))
    judged = quality.judge(docs, shown).where("not base_failed")
    seen = judged.join(good.select("doc_id"), "doc_id").join(shown.select("doc_id", "shown"), "doc_id", "left").join(docs.select("doc_id", "lang"), "doc_id")
    kept = {bool(r.shown): r.share for r in seen.groupBy("shown").agg(F.avg(F.col("kept").cast("int")).alias("share")).collect()}
    assert kept[False] >= kept[True] - 0.03 and kept[True] >= 0.97
    by_lang = [r.share for r in seen.where("shown is null").groupBy("lang").agg(F.avg(F.col("kept").cast("int")).alias("share")).collect()]
    assert min(by_lang) >= 0.85
    junk = judged.join(labels.where("quality = 0"), "doc_id").agg(F.avg(F.col("kept").cast("int"))).first()[0]
    assert junk <= 0.2


def test_repeated_windows_by_lookup_and_by_sorting_agree(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(i, " ".join(str(rng.randint(0, k)) for _ in range(300))) for i, k in enumerate((3, 6, 12, 20, 400))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    both = []
    for few in (0, 4, 10_000):
        monkeypatch.setattr(quality, "FEW", few)
        both.append(sorted((r.doc_id, r.n_repeat_words) for r in quality.with_counts(df).select("doc_id", "n_repeat_words").collect()))
    assert both[0] == both[1] == both[2] == [(d, brute_counts(t)[4]) for d, t in rows]


def test_every_trusted_document_is_counted(spark, monkeypatch):
    n, buckets = 24_000, 1 << 14
    docs = spark.range(n).selectExpr("id as doc_id", "'a b' as text").unionByName(
        spark.createDataFrame([(None, "a b"), (n, "c"), (7, "a b")], "doc_id long, text string"))
    labels = spark.range(n).selectExpr("id as doc_id", "1 as quality", "0 as toxic")
    grams = [hashed(*g) % buckets for g in (("a",), ("b",), ("a", "b"))]
    fold = [(h - (1 << 64) if h >> 63 else h) % 2 for h in (xxhash.xxh64_intdigest(struct.pack("<q", d), 42) for d in [*range(n), 7])]
    want = []
    for f in (0, 1):
        held = fold.count(1 - f)
        want.append(math.log((held + 1) / (3 * held + buckets)) - math.log((n + 3) / (3 * (n + 2) + 1 + buckets)))
    for few in (quality.BROADCAST_IDS, 10):  # ids broadcast, ids joined by a shuffle
        monkeypatch.setattr(quality, "BROADCAST_IDS", few)
        got = quality.log_ratios(docs, labels, buckets=buckets)
        assert np.allclose(got[:, grams], np.array(want)[:, None], atol=1e-9)


def test_the_threshold_is_a_quantile_of_all_trusted_scores(spark):
    n = 21_000
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.array_join(F.transform(F.sequence(F.lit(1), F.lit(50)), lambda i: (
        F.pmod(F.xxhash64("id", i), F.lit(3000)).cast("string"))), " ").alias("text"))
    labels = spark.range(n).selectExpr("id as doc_id", "int(id % 100 > 0) as quality", "0 as toxic")
    rows = quality.judge(docs, labels).select("doc_id", "score", "base_failed", "kept").collect()
    carried = quality.judge(docs, labels, carry=("text",)).select("doc_id", "score", "base_failed", "kept").collect()
    assert sorted(carried) == sorted(rows)
    trusted = [r.score for r in rows if r.doc_id % 100 and not r.base_failed]
    least = float(np.quantile(trusted, quality.LOSS))
    assert len(trusted) > 20_700 and len(set(trusted)) > 20_000
    assert [r for r in rows if r.kept != (r.score >= least)] == []
    assert sum(r.kept for r in rows if r.doc_id % 100) == len(trusted) - math.ceil((len(trusted) - 1) * quality.LOSS)


def test_quality_plans_do_not_hold_the_ratios_as_text(spark):
    rng = random.Random(5)
    docs = spark.createDataFrame([(i, words(rng, 80)) for i in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 60, 2)], "doc_id long, quality int, toxic int")
    for carry in ((), ("text",)):
        judged = quality.judge(docs, labels, buckets=1 << 15, carry=carry)
        assert len(judged._jdf.queryExecution().toString()) < 100_000
        assert judged.count() == 60 and judged.where("score is null").count() == 0
