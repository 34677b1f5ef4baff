"""Spelling variants, cross-tokenizer alignment, online packing: brute force and odd inputs."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from benchlake.llm import alignment, online_packing, spelling
from conftest import words
from tokenizers import Tokenizer

BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(b) != len(a) + 1:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[at:] == b[at + 1:]


def brute_variants(rows):
    n = collections.Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    n = {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}
    near = {w: [x for x in n if one_edit(w, x)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out)


@pytest.fixture(scope="module")
def misspelt():
    rng = random.Random(11)
    base = ["garden", "gardens", "straße", "éclair", "bridge", "bridges", "ÀÖØöøÿ×", "aaaaa", "aaaaaa", "over", "un" * 300]
    rows = []
    for doc in range(40):
        found = []
        for _ in range(90):
            w = list(rng.choice(base[:-1] if doc else base))
            for _ in range(rng.choice((0, 0, 0, 1, 1, 2))):
                at, kind = rng.randrange(len(w)), rng.random()
                w[at:at + (kind < 0.7)] = rng.choice(("", "x", "E", "ü")) if kind < 0.9 else "zz"
            found.append("".join(w))
        rows.append((doc, rng.choice((" ", "-", "\n", "1")).join(found)))
    long = " ".join(["un" * 5_000] * 3 + ["un" * 5_000 + "i"] * 7)
    return [*rows, rows[0], (None, rows[1][1]), (None, None), (90, ""), (91, long)]


@pytest.mark.parametrize("symbols", [None, 2])
def test_variants_match_brute_force(spark, misspelt, symbols):
    df = spark.createDataFrame(misspelt, "doc_id long, text string").selectExpr("*", "1 as word", "2 as n", "3 as key").repartition(4)
    out = spelling.group_variants(df, symbols=symbols)
    assert sorted(map(tuple, out.collect()), key=str) == sorted(brute_variants(misspelt), key=str)


def test_variants_broadcast_no_table(spark, misspelt):
    """Tables that Spark takes for small ones grow with the vocabulary and don't fit the driver."""
    limits = {"spark.sql.autoBroadcastJoinThreshold": "1g", "spark.sql.maxBroadcastTableSize": "1"}
    before = {k: spark.conf.get(k) for k in limits}
    try:
        for k, v in limits.items():
            spark.conf.set(k, v)
        with pytest.raises(Exception, match="Cannot broadcast"):  # the limit holds in this session
            spark.range(9).join(spark.range(3), "id").collect()
        out = spelling.group_variants(spark.createDataFrame(misspelt, "doc_id long, text string").repartition(4)).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted(map(tuple, out), key=str) == sorted(brute_variants(misspelt), key=str)


def test_no_words(spark, no_docs, odd_rows, odd_docs):
    assert spelling.group_variants(no_docs).collect() == []
    assert sorted(map(tuple, spelling.group_variants(odd_docs).collect())) == brute_variants(odd_rows)


def test_neighbourhood_is_all_strings_one_edit_away():
    reduced = np.array([[0, 1, 1], [2, 2, 2]])
    for row, got in zip(reduced, spelling.neighbourhood(reduced, 3), strict=True):
        row = row.tolist()
        want = [row, *(row[:i] + row[i + 1:] for i in range(3)), *(row[:i] + [s] + row[i + 1:] for i in range(3) for s in range(3)),
                *(row[:i] + [s] + row[i:] for i in range(4) for s in range(3))]
        assert set(got.tolist()) == {int(spelling.keys(np.array([w]), 3)[0]) for w in want}


@pytest.mark.parametrize("work", [1, 2, 3, 7, 1000])
def test_pieces_of_the_merge_find_every_shared_end(work):
    rng = np.random.default_rng(work)
    for _ in range(50):
        a, b = (np.cumsum(rng.integers(1, 4, rng.integers(0, 40))) for _ in "ab")
        i, j = alignment.diagonals(a, b, work)
        assert (np.diff(i + j)[:-1] == work).all()
        at_a, at_b = alignment.cuts(a, b, work)
        shared = np.intersect1d(a, b)
        assert (a[at_a - 1] == shared).all() and (b[at_b - 1] == shared).all()


def brute_alignment(rows):
    tok_a = Tokenizer.from_file(BYTES)
    tok_a.encode_special_tokens = True
    tok_b = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    pair, count, per = alignment.Pair(BYTES, PIECES), collections.Counter(), []
    for doc, text in rows:
        raw = (" " + (text or "")).encode()
        a, b = tok_a.encode(raw.decode(), add_special_tokens=False).ids, tok_b.encode(text or "")
        bytes_a, bytes_b = [pair.bytes_a[i] for i in a], [pair.bytes_b[i] for i in b]
        if not text or b"".join(bytes_a) != raw or b"".join(bytes_b) != raw:
            per.append((doc, 0, 0, [], {}))
            continue
        ends = set(np.cumsum(list(map(len, bytes_a))).tolist()) & set(np.cumsum(list(map(len, bytes_b))).tolist())
        groups, at = collections.defaultdict(lambda: ([], [])), np.array(sorted(ends))
        for side, ids, size in ((0, a, bytes_a), (1, b, bytes_b)):
            for i, end in zip(ids, np.cumsum(list(map(len, size))).tolist(), strict=True):
                groups[int(np.searchsorted(at, end))][side].append(i)
        links = collections.Counter((x, y) for ga, gb in groups.values() for x in ga for y in gb)
        count.update(links.keys())
        per.append((doc, len(a), len(b), [groups[k] for k in sorted(groups)], links))
    best = collections.defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    out = []
    for doc, a, b, groups, links in per:
        shown = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((doc, a, b, len(groups), sum(links.values()), sum(n for p, n in links.items() if count[p] == best[p[0]]),
                    sum(n * count[p] for p, n in links.items()), hashlib.sha256(shown.encode()).hexdigest() if groups else ""))
    return sorted(out, key=str)


ODD_TEXTS = [" ", "a  b\n c", "a▁b", "<|endoftext|> <s> <0x0A>", "日本語 テスト \x00\x1c x  y　z", " \n lead", "trail \n", "é 😀😀 ​",
             "=" * 3000 + " " + "  " * 700 + "ab" * 2000, "a\x85 b  c  d", "don't we'll\t'tis", "﻿mark", "ﬁ ½ Ａ"]


@pytest.mark.parametrize("hot", [0, 40, 1 << 18])
def test_alignment_matches_brute_force(spark, odd_rows, hot, monkeypatch):
    if hot == 40:  # many slices, pieces and blocks, groups reduced to their distinct ids
        monkeypatch.setattr(alignment, "BYTES_AT_ONCE", 200)
        monkeypatch.setattr(alignment, "LINKS_AT_ONCE", 4)
        monkeypatch.setattr(alignment, "KEPT", 50)
    rows = [r for r in odd_rows if not r[1] or len(r[1]) < 10_000] + [(100 + i, t) for i, t in enumerate(ODD_TEXTS)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as row", "2 as pairs", "3 as n_a").repartition(3)
    assert sorted(map(tuple, alignment.align(df, BYTES, PIECES, hot_pairs=hot).collect()), key=str) == brute_alignment(rows)


def test_alignment_of_nothing_and_of_long_texts(spark, no_docs, odd_rows, odd_docs):
    assert alignment.align(no_docs, BYTES, PIECES).collect() == []
    got = sorted(map(tuple, alignment.align(odd_docs, BYTES, PIECES).collect()), key=str)
    assert got == brute_alignment(odd_rows)


def test_small_pieces_give_the_same_columns():
    pair = alignment.Pair(BYTES, PIECES)
    rng = random.Random(5)
    texts = pa.array([words(rng, 200), "", *ODD_TEXTS, "x" * 5000, words(rng, 50)])
    whole = alignment.align_texts(pair, texts)
    assert all(x == y for x, y in zip(whole, alignment.align_texts(pair, texts, work=3), strict=True))


def packed(df, **kind):
    return [r.asDict() for r in online_packing.pack(df, WORDS, **kind).collect()]


def check_packing(rows, out, capacity):
    tokenizer = Tokenizer.from_file(WORDS)
    ids = collections.Counter(np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4").tobytes() for _, t in rows)
    pieces, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in out:
        pieces[r["doc_id"], r["doc_tokens"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    short = []
    for runs in sequences.values():
        at = 0
        for offset, length in sorted(runs):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
        if at < capacity:
            short.append(at)
    assert sum(r["length"] for r in out) == sum(len(k) // 4 * n for k, n in ids.items())
    assert len(set(short)) == len(short) and all(x & (x - 1) == 0 for x in short)  # different powers of two
    by_id = collections.defaultdict(list)
    for doc, text in rows:
        by_id[doc].append(np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4").tobytes())
    for (doc, size), own in pieces.items():
        texts = [x for x in by_id[doc] if len(x) == 4 * size]
        assert sum(r["length"] for r in own) == size * len(texts)
        assert all(any(zlib.crc32(x[4 * r["start"]:4 * (r["start"] + r["length"])]) == r["ids_crc32"] for x in texts) for r in own)
        if len(texts) == 1:
            own.sort(key=lambda r: r["start"])
            assert [r["start"] for r in own] == [sum(q["length"] for q in own[:k]) for k in range(len(own))]


@pytest.mark.parametrize(("capacity", "windows", "fan_in", "parts"), [(2048, 32, 8, 3), (64, 4, 2, 7), (16, 1, 3, 5), (1, 1, 2, 2)])
def test_packing_keeps_every_token_without_padding(spark, odd_rows, odd_docs, capacity, windows, fan_in, parts):
    rows = odd_rows if capacity > 16 else [r for r in odd_rows if not r[1] or len(r[1]) < 2000]
    df = odd_docs if capacity > 16 else spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    check_packing(rows, packed(df.repartition(parts), capacity=capacity, windows=windows, fan_in=fan_in), capacity)


def test_packing_of_a_table(spark, no_docs):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    out = packed(docs.repartition(11), fan_in=2)
    check_packing(rows, out, 2048)
    n = collections.Counter(r["doc_id"] for r in out)
    whole = [r["doc_id"] for r in out if r["doc_tokens"] <= 2048 and r["start"] == 0]
    assert sum(n[d] == 1 for d in whole) > 0.6 * len(whole)  # most documents that fit a window stay whole
    assert packed(no_docs) == []


def test_best_fit_and_emission_of_the_fullest():
    def part(doc, n):
        return [(doc, 0, b"\0\0\0\0" * n, n)]

    own = online_packing.Windows(10, 2, 0)
    for doc, n in ((1, 4), (2, 7), (3, 3)):  # 3 leaves the second window fullest, and full
        own.add(part(doc, n), n)
    assert [r[0] for r in own.done] == [2, 3]
    own.add(part(4, 8), 8)  # a new window, as none has room
    own.add(part(5, 7), 7)  # no room, none to open: its head completes the fullest, the rest fits the other
    assert [(r[0], r[1], r[2]) for r in own.done[2:]] == [(4, 0, 8), (5, 0, 2)]
    assert own.gaps == [(1, 0)]
