"""Jaccard join, decontamination, packing: brute force and odd inputs."""

import collections
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from benchlake.llm import common, decontam, jaccard_join, line_dedup, packing
from conftest import words

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def brute_join(rows):
    """Class and links of every row, by comparing all pairs."""
    sets = []
    for _, t in rows:
        w = (t or "").translate(str.maketrans("\t\n\x0b\x0c\r", "     ")).split(" ")
        w = [x for x in w if x]
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    links, root = [0] * len(rows), list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if rows[i][0] is None or rows[j][0] is None or not sets[i] or not sets[j]:
                continue
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                links[i], links[j] = links[i] + 1, links[j] + 1
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted((str(d), str(least.get(find(i)) if d is not None else None), links[i]) for i, (d, _) in enumerate(rows))


def joined(df):
    return sorted((str(r.doc_id), str(r.class_id), r.n_links) for r in jaccard_join.near_duplicates(df).collect())


def test_join_matches_brute_force(spark, odd_rows, odd_docs, no_docs):
    assert joined(odd_docs) == brute_join(odd_rows)
    assert joined(no_docs) == []


def test_join_of_large_groups_in_blocks(spark, monkeypatch):
    rng = random.Random(8)
    base = words(rng, 200).split()
    rows = []
    for i in range(60):  # near copies of one text, some of them linked only through others
        w = list(base)
        for _ in range(rng.randint(0, 6)):
            w[rng.randrange(len(w))] = f"new{rng.randint(0, 9)}"
        rows.append((i, " ".join(w)))
    rows += [(100 + i, words(rng, 60)) for i in range(30)] + [(200 + i, rows[3][1]) for i in range(5)]
    monkeypatch.setattr(jaccard_join, "BUCKET_BLOCK", 16)
    monkeypatch.setattr(jaccard_join, "GROUP_BLOCK", 8)
    assert joined(spark.createDataFrame(rows, "doc_id long, text string")) == brute_join(rows)


def test_depth_is_the_longest_that_reaches_the_recall():
    assert jaccard_join.forest_depth(24, 0.8, 0.99, 12) == 7
    assert 1 - (1 - 0.8 ** 7) ** 24 >= 0.99 > 1 - (1 - 0.8 ** 8) ** 24


def test_a_trie_chains_what_its_members_signatures_allow():
    rng = np.random.default_rng(5)
    for _ in range(60):
        n, levels = int(rng.integers(3, 30)), int(rng.integers(0, 4))
        sketches = rng.integers(0, 2, (n, 24), dtype=np.uint8)
        for u in range(1, n):  # some near copies of earlier members
            if rng.random() < 0.6:
                sketches[u] = sketches[rng.integers(0, u)]
                sketches[u, rng.integers(0, 24, 3)] ^= 1
        sketches = sketches[np.lexsort(sketches[:, :max(levels, 1)].T[::-1])]
        edges = jaccard_join.trie_links(sketches[:, :levels], sketches, 0.8)
        assert all((sketches[u] == sketches[v]).mean() >= 0.8 for u, v in edges)

        def groups(links):
            root = list(range(n))
            for u, v in links:
                a, b = root[u], root[v]
                root = [a if x == b else x for x in root]
            return {frozenset(i for i in range(n) if root[i] == r) for r in root}

        near = [(u, v) for u in range(n) for v in range(u) if (sketches[u] == sketches[v]).mean() >= 0.8]
        assert groups(edges) == groups(near)
        assert len(edges) == n - len(groups(edges))  # a forest: never a row per pair


def test_a_trie_is_not_shortened_once_it_is_one_group(monkeypatch):
    compared = []
    flat = np.flatnonzero
    monkeypatch.setattr(jaccard_join.np, "flatnonzero", lambda x: compared.append(int(np.sum(x))) or flat(x))
    copies = np.zeros((50, 24), np.uint8)
    assert len(jaccard_join.trie_links(copies[:, :3], copies, 0.8)) == 49
    assert sum(c for c in compared if c == 49) == 49  # one member met the others, at the longest prefix


def test_forest_finds_pairs_at_the_threshold(spark):
    rng = random.Random(12)
    rows = []
    for i in range(400):  # pairs of Jaccard 0.80 to 0.83: one changed word of 5-word shingles in 46 to 56 words
        w = [f"w{rng.randint(0, 99999)}" for _ in range(rng.randint(50, 58))]
        x = list(w)
        x[rng.randrange(6, len(w) - 6)] = "changed"
        rows += [(2 * i, " ".join(w)), (2 * i + 1, " ".join(x))]
    want = brute_join(rows)
    got = joined(spark.createDataFrame(rows, "doc_id long, text string"))
    linked = {d for d, _, n in want if n}
    assert len(linked) > 600
    assert len({d for d, _, n in got if n} & linked) >= 0.99 * len(linked)
    assert {d for d, _, n in got if n} <= linked


def edit_distance_anywhere(item, text):
    row = [0] * (len(text) + 1)
    for i, x in enumerate(item, 1):
        new = [i]
        for j, y in enumerate(text, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_best_passage_is_the_exact_edit_distance():
    rng = np.random.default_rng(2)
    for _ in range(200):
        item, text = rng.integers(0, 5, rng.integers(1, 12)), rng.integers(0, 5, rng.integers(1, 30))
        edits, start, end = decontam.best_passage(item, text)
        assert edits == edit_distance_anywhere(list(item), list(text))
        assert 0 <= start <= end <= len(text)
        assert edit_distance_anywhere(list(item), list(text[start:end])) == edits


def test_recall_of_edited_passages_is_at_least_the_target():
    rng = random.Random(4)
    items = [(i, words(rng, rng.randint(15, 50))) for i in range(40)]
    index = decontam.Index(items, 0.2, 0.99, 2)
    found = total = 0
    for _ in range(300):
        i, text = rng.choice(items)
        w = text.split()
        edits = rng.randint(0, int(0.2 * len(w)))
        for _ in range(edits):
            at, kind = rng.randrange(len(w)), rng.random()
            if kind < 0.34:
                w[at] = f"zz{rng.randint(0, 99)}q"
            elif kind < 0.67:
                w.insert(at, f"yy{rng.randint(0, 99)}q")
            else:
                del w[at]
        host = [f"host{rng.randint(0, 500)}" for _ in range(80)]
        at = rng.randrange(80)
        hits = decontam.search(index, pa.array([" ".join(host[:at] + w + host[at:])]), {})
        total += 1
        found += any(h[1] == i and h[2] <= edits for h in hits)
    assert found >= 0.98 * total, (found, total)


@pytest.mark.parametrize(("size", "kind"), [(32, "delete"), (33, "delete"), (59, "delete"), (150, "delete"), (400, "delete"),
                                            (32, "insert"), (150, "insert"), (150, "replace")])
def test_recall_at_the_bound_does_not_sink_with_the_length(size, kind):
    rng = random.Random(size)
    items = [(i, " ".join(f"i{i}w{rng.randint(0, 3 * size)}" for _ in range(size))) for i in range(25)]
    index = decontam.Index(items, 0.2, 0.99, 2)
    texts = []
    for _, text in items:
        w = text.split()
        for _ in range(index.allowed(size)):
            at = rng.randrange(len(w))
            w[at:at + (kind != "insert")] = [] if kind == "delete" else [f"new{rng.randint(0, 99)}"]
        host = [f"host{rng.randint(0, 500)}" for _ in range(40)]
        texts.append(" ".join(host + w + host))
    hits = {(h[0], h[1]) for h in decontam.search(index, pa.array(texts), {})}
    assert len(hits) >= 0.98 * len(texts)


def test_contaminated_documents(spark, odd_docs, no_docs):
    rng = random.Random(6)
    item = words(rng, 30)
    bench = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, item), (5, "short one here"), (None, words(rng, 20))],
                                  "item_id long, text string")
    clean = words(rng, 200)
    docs = spark.createDataFrame([(1, f"{clean} {item.upper()}. {clean}"), (1, f"{clean} {item.upper()}. {clean}"), (2, clean),
                                  (3, item), (None, f"x {item}"), (4, None), (5, ""), (6, f"see: SHORT, one here!")],
                                 "doc_id long, text string")
    got = sorted((str(r.doc_id), str(r.item_id), r.edits) for r in decontam.contaminated(docs, bench).collect())
    assert got == sorted([(d, i, 0) for d in ("1", "1", "3", "None") for i in ("1", "4")] + [("6", "5", 0)])
    row = decontam.contaminated(docs, bench).where("doc_id = 1 and item_id = 1").first()
    assert (row.start_word, row.n_words, row.item_words) == (200, 30, 30)
    blocks = decontam.contaminated(docs, bench, block_items=2)  # the query set in blocks finds the same
    assert sorted((str(r.doc_id), str(r.item_id), r.edits) for r in blocks.collect()) == got
    assert decontam.contaminated(odd_docs, bench).where("item_id = 1").count() == 0
    assert decontam.contaminated(no_docs, bench).count() == 0
    assert decontam.contaminated(docs, bench.where("item_id < 0")).count() == 0


def test_ids_are_the_tokenizers():
    ids = packing.Ids(TOKENIZER)
    rng = random.Random(1)
    texts = ["IT'S naïve 'Student\t<|endoftext|> x<|startoftext|>y  İSTANBUL ΣΟΦΟΣ é e\u0301a 日本語 ½ 123 🙂🙂 \x1c a\x1cb \ufeff z",
             "a\r\nb c", "", " ", "\n\n", words(rng, 300), "\u00a0x\u2003y", "don't WON'T we'Ll", "a|b||c !! ###"]
    texts += ["".join(rng.choice("aAéÉ'’ \n\t.,!|<>1²ßΣσς中😀\u0301") for _ in range(60)) for _ in range(200)]
    got = [x.tolist() for x in ids.of(pa.array(texts))]
    assert got == [e.ids for e in ids.tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_words_are_kept_once_whatever_signs_follow_them():
    ids = packing.Ids(TOKENIZER)
    texts = ["River river. RIVER,\triver!! ri\u00e7e; \u00d7.", "", "river.\r\n", "(river)."]
    want = [e.ids for e in ids.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in ids.of(pa.array(texts))] == want
    assert set(ids.chunks) == {"river", ".", ",", "!!", "ri\u00e7e", ";", "\u00d7.", "(river)."}
    ids = packing.Ids(TOKENIZER)
    texts = ["H\u0331 The. THE", "", "x.<|endoftext|>. <|ENDOFTEXT|>, a<|startoftext|>!a THE", "E\u0301. \u00c9! \u1e96 \u0130. \u03a3\u03a3,",
             "!\u0301a. <\u0338. a\u00f7. \u00c7. \u00aa. \u00b2. 1.5 a.b #a's 's. don't."]
    rng = random.Random(4)
    signs = [*"aAzZ\u00e9\u00c9\u00d7\u00f7\u00b5\u00aa\u0130\u03a3\u4e2d1\u00b2\U0001f600\u0301\u0331'<|>(.,!?;:#*$%&  \t\r\n\x0b\x1c\x85\xa0", "<|endoftext|>"]
    texts += ["".join(rng.choices(signs, k=rng.randint(0, 40))) for _ in range(300)]
    want = [e.ids for e in ids.tokenizer.encode_batch(texts, add_special_tokens=False)]
    for k in (len(texts), 7, 1):
        parts = [ids.of(pa.array(texts)[at:at + k]) for at in range(0, len(texts), k)]
        assert [x.tolist() for part in parts for x in part] == want
    assert [x.tolist() for x in ids.of(pa.array(["", ""]))] == [[], []] and ids.of(pa.array([], pa.string())) == []


def test_plan_holds_every_piece_and_is_near_the_bound():
    rng = random.Random(2)
    for n in (1, 5, 400, 20_000):
        histogram = collections.Counter(min(4096, max(1, int(rng.lognormvariate(6, 1)))) for _ in range(n))
        runs = packing.plan(histogram)
        held = collections.Counter()
        for lengths, k in runs:
            assert k > 0 and sum(lengths) <= 4096
            for x in lengths:
                held[x] += k
        assert held == histogram
        bound = -(-sum(k * v for k, v in histogram.items()) // 4096)
        assert sum(k for _, k in runs) <= 1.01 * bound + 1


def test_packing_of_odd_documents(spark, odd_rows, odd_docs, no_docs):
    rows = packing.pack(odd_docs, TOKENIZER).collect()
    ids = packing.Ids(TOKENIZER)
    want = collections.Counter()
    for d, t in odd_rows:
        flat = ids.tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        for k, at in enumerate(range(0, len(flat), 4096)):
            part = flat[at:at + 4096]
            want[d, k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    sequences = collections.defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    assert packing.pack(no_docs, TOKENIZER).count() == 0


def test_workers_take_a_batch_in_slices_and_give_memory_back(monkeypatch):
    class Docs:
        def mapInArrow(self, work, schema):
            return work

    jaccard_join.shingles("one")  # the worker's cache is there, from now on memory goes back at the end only
    back = []
    monkeypatch.setattr(common, "give_back", lambda: back.append(1))
    text = " ".join(f"word{i}" for i in range(10_000))
    batch = pa.record_batch([pa.array(range(100)), pa.array([f"{text} {i}" for i in range(100)])], names=["doc_id", "text"])
    odd = pa.record_batch([pa.array([100, 101]), pa.array([text * 60, None])], names=["doc_id", "text"])
    none = batch.slice(0, 0)
    assert batch.nbytes > 2 * common.BYTES_AT_ONCE and odd.nbytes > common.BYTES_AT_ONCE
    work = jaccard_join.signatures(Docs(), 5, 24, 7, 10)
    out = list(work(iter([batch, none, odd])))
    assert [x for b in out for x in b["doc_id"].to_pylist()] == list(range(102)) and back == [1]
    assert max(b.num_rows for b in out) * len(text) <= common.BYTES_AT_ONCE
    monkeypatch.setattr(common, "BYTES_AT_ONCE", 1 << 40)
    assert pa.Table.from_batches(out).to_pylist() == pa.Table.from_batches(work(iter([batch, none, odd]))).to_pylist()
    monkeypatch.undo()
    raw = pa.record_batch([batch["doc_id"], batch["text"].cast(pa.binary())], names=["doc_id", "raw"])
    lines = list(line_dedup.line_counts(Docs(), 20)(iter([raw])))
    assert len(lines) > 1 and sum(b.num_rows for b in lines) == 100


def test_a_worker_keeps_no_long_words():
    long = "x" * 100_000
    jaccard_join.shingles(f"short {long} words")
    known = common.worker_cache("word hashes", jaccard_join._WordHash)
    assert "short" in known and long not in known
    assert (jaccard_join.shingles(f"{long} a") == jaccard_join.shingles(f"{long} a")).all()
