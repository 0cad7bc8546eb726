"""The operators against brute force on small tables, and their edge cases."""

import collections
import hashlib
import itertools
import math
import random
import re
import sys
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from delaycast.llm import ann, components, gru, hashing, jaccard, licenses, mixing, packing, quality, queries, rules, suffix, viterbi

WORD = re.compile(r"[^\x20\x09-\x0D]+").findall
SF = "/root/testdata/sf0.001"
BPE = f"{queries.TOKENIZERS}/word_bpe_49k.json"
PIECES = f"{queries.TOKENIZERS}/piece_bpe_32k.model"


def prose(rng, n, vocab=400):
    return " ".join("w%d" % int(vocab * rng.random() ** 2) for _ in range(n))


def edited(rng, text, changes):
    words = text.split()
    for _ in range(changes):
        words[rng.randrange(len(words))] = "x%d" % rng.randrange(10**6)
    return " ".join(words)


@pytest.fixture(scope="module")
def mixed_rows():
    """Ordinary texts, copies, near copies, shared passages, and odd cases."""
    rng = random.Random(5)
    base = [prose(rng, rng.choice([3, 12, 60, 200, 300])) for _ in range(30)]
    passage = prose(rng, 70, 10**6)
    texts = base + base[:3] + [edited(rng, base[i], k) for i in range(12) for k in (1, 3, 8)]
    texts += [f"{prose(rng, 30)} {passage} {prose(rng, 40)}" for _ in range(6)]
    texts += [None, None, "", "  \n\t ", "one", "one", "ab " * 400, "é" * 350, "ü ö " * 90, prose(rng, 20_000)]
    rows = [(i * 7 - 20, t) for i, t in enumerate(texts)]
    return rows + [rows[4], rows[4], (None, base[5]), (None, None)]


# ---- 1: n-gram Jaccard join

def jaccard_brute(rows, t=0.8):
    sets = {}
    for i, (doc, text) in enumerate(rows):
        w = WORD((text or "").lower())
        if doc is not None:
            sets[i] = frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
    near = collections.defaultdict(set)
    for i, j in itertools.combinations(sets, 2):
        a, b = sets[i], sets[j]
        if a and b and len(a & b) >= t * len(a | b) - 1e-9:
            near[i].add(j)
            near[j].add(i)
    out, seen = {}, {}
    for i in sets:
        if i not in seen:
            group, todo = {i}, [i]
            while todo:
                for j in near[todo.pop()] - group:
                    group.add(j)
                    todo.append(j)
            for j in group:
                seen[j] = min(rows[k][0] for k in group)
        out[i] = (rows[i][0], seen[i], len(near[i]))
    return sorted(out.values()) + [(None, None, 0)] * sum(r[0] is None for r in rows)


def test_jaccard_equals_brute_force(make_docs, mixed_rows):
    got = [tuple(r)[:3] for r in jaccard.similar(make_docs(mixed_rows), block=4).collect()]
    assert sorted(got, key=lambda r: (r[0] is None, r)) == jaccard_brute(mixed_rows)


def test_jaccard_one_of_each(make_docs, mixed_rows):
    docs = make_docs(mixed_rows)
    got = collections.Counter(r["doc_id"] for r in jaccard.one_of_each(docs).collect())
    want = collections.Counter({c for _, c, _ in jaccard_brute(mixed_rows) if c is not None})
    want[None] = 2
    assert got == want
    assert jaccard.one_of_each(docs).columns == docs.columns


def test_jaccard_empty(make_docs):
    assert jaccard.similar(make_docs([])).count() == 0


def test_posterior_rule_drops_only_below_tolerance():
    for h, m in jaccard.least_matches(16, 0.8, 1e-6):
        tail = lambda k: sum(math.comb(h + 1, i) * 0.8**i * 0.2 ** (h + 1 - i) for i in range(k + 1))
        assert tail(m) >= 1e-6 and (m == 0 or tail(m - 1) < 1e-6)


def test_gram_sets_across_batches(monkeypatch):
    rng = random.Random(1)
    texts = [prose(rng, n) for n in (0, 1, 4, 5, 6, 50, 3000)]
    one = [s.tolist() for s in jaccard.gram_sets(texts)]
    monkeypatch.setattr(jaccard, "TOGETHER", 10)
    assert one == [s.tolist() for s in jaccard.gram_sets(texts)]
    assert [len(s) for s in one[:4]] == [0, 1, 1, 1]


def test_components(spark):
    rng = random.Random(2)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(40)]
    parent = {x: x for p in pairs for x in p}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {x: root(x) for x in linked}


# ---- 2: suffix-array dedup

def suffix_brute(rows, length=200):
    count = collections.Counter()
    raws = [(t or "").encode() for _, t in rows]
    for t in raws:
        count.update(t[k:k + length] for k in range(len(t) - length + 1))
    out = []
    for (doc, _), t in zip(rows, raws):
        cover = np.zeros(len(t) + 1, dtype=int)
        for k in range(len(t) - length + 1):
            if count[t[k:k + length]] > 1:
                cover[k] += 1
                cover[k + length] -= 1
        cover = np.cumsum(cover)[:len(t)] > 0
        left = np.frombuffer(t, dtype=np.uint8)[~cover].tobytes()
        out.append((doc, len(t), int(cover.sum()), int((np.diff(np.concatenate(([0], cover.astype(int)))) == 1).sum()), hashlib.sha256(left).hexdigest()))
    return sorted(out, key=lambda r: (r[0] is None, r))


@pytest.mark.parametrize("split_at", [2000, 2])
def test_suffix_equals_brute_force(make_docs, mixed_rows, monkeypatch, split_at):
    monkeypatch.setattr(suffix, "SPLIT_AT", split_at)
    got = [tuple(r) for r in suffix.deduplicated(make_docs(mixed_rows)).collect()]
    assert sorted(got, key=lambda r: (r[0] is None, r)) == suffix_brute(mixed_rows)


def test_suffix_classes_of_a_frequent_anchor_meet_in_no_task(make_docs, monkeypatch):
    rng, limit, compare = random.Random(8), 20, suffix.compare_bucket
    passage = prose(rng, 80)
    rows = [(i, f"{prose(rng, 60)} {passage[i % 3:]} {prose(rng, 60)}") for i in range(90)]

    def spy(g, length):
        if g.groupby("h").size().max() > limit:
            raise ValueError("a frequent anchor's classes in one frame")
        return compare(g, length)

    monkeypatch.setattr(suffix, "SPLIT_AT", limit)
    monkeypatch.setattr(suffix, "compare_bucket", spy)
    assert sorted(tuple(r) for r in suffix.deduplicated(make_docs(rows)).collect()) == suffix_brute(rows)


def test_suffix_texts(make_docs, mixed_rows):
    docs = make_docs(mixed_rows)
    done = suffix.without_repeats(docs)
    assert done.columns == docs.columns
    want = {r[0]: r for r in suffix_brute(mixed_rows)}
    for r in done.where("doc_id is not null").collect():
        if want[r["doc_id"]][2] == 0:
            assert r["text"] == (dict(mixed_rows)[r["doc_id"]] or "") and r["row"] == "r"
        else:
            assert r["n_chars"] == len(r["text"]) and r["text"].split()


def test_suffix_empty(make_docs):
    assert suffix.deduplicated(make_docs([])).count() == 0


def test_anchors_in_pieces(monkeypatch):
    raw = np.random.default_rng(0).integers(97, 101, 5000, dtype=np.uint8)
    whole = suffix.anchors(raw, 200)
    monkeypatch.setattr(suffix, "PIECE", 700)
    parts = suffix.anchors(raw, 200)
    place = lambda a: {p: x for h, x, f, last in zip(*map(list, a)) for p in range(f, last + 1)}
    assert place(whole) == place(parts) and len(place(whole)) == 4801
    values = hashing.Sums(raw).all(suffix.K) & ~suffix._POSITION
    assert all(x == p + int(values[p:p + 161].argmin()) for p, x in place(whole).items())


def test_equal_hashes_are_told_apart(monkeypatch):
    buffer = np.frombuffer(b"a" * 80 + b"b" * 80 + b"a" * 80, dtype=np.uint8)
    monkeypatch.setattr(hashing.Sums, "of", lambda self, s, e: np.zeros(len(s), dtype=np.uint64))
    assert suffix.repeated_strings(buffer, np.array([0, 80, 160]), np.zeros(3, dtype=int), 80).tolist() == [True, False, True]


# ---- 3: best-fit packing

def test_packing_round_trip(make_docs, mixed_rows):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(BPE)
    rows = mixed_rows + [(900, "<|endoftext|> x"), (901, "ΣΑΣ é日本"), (902, "it's a''s\x1cb\x85c")]
    got = packing.pack_documents(make_docs(rows), BPE, capacity=256).collect()
    want = collections.Counter()
    for doc, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        for n, at in enumerate(range(0, len(ids), 256)):
            part = np.array(ids[at:at + 256], dtype="<u4")
            want[(doc, n, at, len(part), zlib.crc32(part.tobytes()))] += 1
    assert collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    by = collections.defaultdict(list)
    for r in got:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for items in by.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= 256
    alone = packing.best_fit(np.array([r["length"] for r in got]), 256).max() + 1  # all in one task
    assert len(by) <= 1.01 * alone + 1


def test_packing_merges_over_rounds(spark):
    parts = spark.range(3000).repartition(12).select(F.col("id").alias("doc_id"), F.lit(0).alias("piece"), F.lit(0).cast("long").alias("start"),
                                                     (1 + F.col("id") * 7919 % 700).alias("length"), F.lit(0).cast("long").alias("ids_crc32"))
    got = packing.pack(parts, 1000, slack=0, task_items=100, fan_in=2).groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("e")).collect()
    assert all(r["n"] == r["e"] <= 1000 for r in got)
    total = sum(r["n"] for r in got)
    assert total == sum(1 + i * 7919 % 700 for i in range(3000)) and len(got) <= 1.03 * total / 1000


def test_best_fit_takes_the_fullest_bin():
    assert packing.best_fit(np.array([6, 5, 4, 5]), 10).tolist() == [0, 1, 0, 1]
    assert packing.best_fit(np.array([], dtype=int), 10).tolist() == []


def test_packing_empty(make_docs):
    assert packing.pack_documents(make_docs([]), BPE).count() == 0


def test_word_tokenizer_is_exact():
    t = packing.WordTokenizer(BPE)
    for x in ["".join(map(chr, range(256))) * 2, "é ä", "Ünï!!'s 12a3 I'LL 'sx", "", "ª²½µß ÀÉ", "a\x00b"]:
        assert t.ids(x) == np.array(t.whole.encode(x, add_special_tokens=False).ids, dtype="<u4").tobytes()


# ---- 4: quality classifier

def test_quality_held_out(spark):
    got = queries.quality_classifier(spark, "/root/testdata/sf0.1").join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id").where("held_out").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in got]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in got)


def test_quality_edge_cases(spark, make_docs, mixed_rows):
    docs = make_docs(mixed_rows)
    none = quality.fit(docs, spark.createDataFrame([(1, None), (None, 1)], "doc_id long, quality int"))
    assert none is None and {r[quality.SCORE] for r in quality.score(docs, none).collect()} == {0.5}
    rng = random.Random(3)
    rows = [(i, prose(rng, 80) if i % 2 else "ha! " * 60) for i in range(60)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(1, 1)], "doc_id long, quality int")
    model = quality.fit(make_docs(rows), labels)
    assert all((r[quality.SCORE] >= 0.3) == bool(r["doc_id"] % 2) for r in quality.score(make_docs(rows), model).collect())
    done = quality.score(docs, model)
    assert done.count() == len(mixed_rows) and done.columns == [*docs.columns, quality.SCORE]
    assert quality.score(make_docs([]), model).count() == 0


def test_pair_weights_rank():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 3))
    good = x @ [2, -1, 0] + rng.normal(0, 0.3, 400) > 0
    w = quality.fit_pairs(x[good], x[~good], 20_000)
    assert (np.subtract.outer(x[good] @ w, x[~good] @ w) > 0).mean() > 0.97


# ---- 5: language model

def test_lm_against_brute_force(make_docs, mixed_rows):
    held = F.col("doc_id") % 5 == 0
    got = gru.scored(make_docs(mixed_rows), held).collect()
    assert len(got) == len(mixed_rows)
    counts = collections.Counter()
    low = lambda t: [w.encode() for w in re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))] + [None]
    for doc, text in mixed_rows:
        if doc is None or doc % 5:
            counts.update(low(text))
    total, distinct = sum(counts.values()), len(counts)
    want = sorted((doc or 0, len(low(t)), sum(counts[w] > 0 for w in low(t)), total, round(sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in low(t)), 4)) for doc, t in mixed_rows)
    assert sorted((r["doc_id"] or 0, r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in got) == want
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in got)


def test_lm_trains_on_every_training_row_once(make_docs, monkeypatch, tmp_path):
    seen = str(tmp_path)

    class Spy(gru.Trainer):
        def train(self, texts):
            with open(f"{seen}/{random.SystemRandom().getrandbits(64)}", "w") as f:
                f.write("\n".join(str(len(t)) for t in texts))
            gru.Trainer.train(self, texts)

    monkeypatch.setattr(gru, "Trainer", Spy)
    gru.scored(make_docs([(i, "w " * i) for i in range(60)]), F.col("doc_id") % 5 == 0).write.format("noop").mode("overwrite").save()
    assert sorted(int(x) for p in tmp_path.iterdir() for x in p.read_text().split()) == [i + 1 for i in range(60) if i % 5]


def test_lm_no_training_rows_and_empty(make_docs):
    got = gru.scored(make_docs([(5, "a b"), (10, None)]), F.lit(True)).collect()
    assert {(r["doc_id"], r["n_known"], r["train_tokens"], r["base_score"]) for r in got} == {(5, 0, 0, 0.0), (10, 0, 0, 0.0)}
    assert gru.scored(make_docs([]), F.lit(False)).count() == 0


def test_gru_gradient_and_windows():
    rng = np.random.default_rng(0)
    start = gru.Gru.start(np.ones(gru.HEAD) * 5, np.ones(gru.LOOKS) * 50).vector.astype(np.float64)
    start += rng.normal(0, 0.05, len(start))
    grid = rng.integers(0, gru.HEAD + gru.LOOKS, (6, 3))
    fresh, live = np.zeros((6, 3), dtype=bool), np.ones((6, 3), dtype=bool)
    fresh[0], fresh[3, 1], live[4:, 2] = True, True, False

    def loss(v):
        m, h, total = gru.Gru(v), np.zeros((3, gru.HIDDEN)), 0
        for s in range(6):
            h = h * ~fresh[s][:, None]
            total -= m.outputs(h, grid[s])[live[s]].sum()
            h = m.step(grid[s], h)[0]
        return total / (32 * 32)

    t = gru.Trainer(gru.Gru(start.copy()), lanes=32, window=32)
    t.learn(grid, fresh, live, np.zeros((3, gru.HIDDEN)))
    slope = t.first * 10
    for k in rng.choice(np.flatnonzero(slope), 20, replace=False):
        step = np.zeros(len(start))
        step[k] = 1e-5
        assert (loss(start + step) - loss(start - step)) / 2e-5 == pytest.approx(slope[k], rel=1e-2, abs=1e-7)
    m = gru.Gru(start.astype(np.float32))
    texts = [rng.integers(0, gru.HEAD + gru.LOOKS, n) for n in (1, 5, 70, 131)]
    assert np.allclose(m.score(texts, lanes=2, window=7), m.score(texts), rtol=1e-4)
    # the probabilities of all next tokens sum to one
    state = rng.normal(size=(1, gru.HIDDEN)).astype(np.float32)
    every = np.arange(gru.HEAD + gru.LOOKS)
    assert np.exp(m.outputs(np.repeat(state, len(every), axis=0), every)).sum() == pytest.approx(1, abs=1e-4)


def test_gru_learns():
    rng = np.random.default_rng(1)
    texts = [np.array([3, 40, 99, 700] * 12 + [gru.END], dtype=np.int32) for _ in range(64)]
    m = gru.Gru.start(np.ones(gru.HEAD), np.ones(gru.LOOKS))
    before = m.score(texts[:2]).sum()
    t = gru.Trainer(m)
    for _ in range(40):
        t.train([texts[i] for i in rng.permutation(64)])
    assert m.score(texts[:2]).sum() > before / 3


def test_gru_windows_grow_as_streams_end():
    rng = np.random.default_rng(2)
    texts = [rng.integers(0, gru.END, n) for n in (20_000, *[100] * 300)]
    t = gru.Trainer(gru.Gru.start(np.ones(gru.HEAD), np.ones(gru.LOOKS)))
    t.train(texts)
    assert t.tokens == sum(map(len, texts)) and t.steps < 100  # 625 windows of 32 before
    assert np.isfinite(t.m.vector).all()


def test_lm_words_and_looks_without_a_call_for_each_word():
    latin = {**dict.fromkeys(b"\xa7\xa8\xa9\xaa\xab\x80\x87\x88\x89\x8a", 1), **dict.fromkeys(b"\xa4\xb6\xbc\x9f\x84\x96\x9c", 2)}

    def plain(word):
        accent = 0 if word.isascii() else next((latin.get(b, 3) for a, b in zip(word, word[1:]) if a >= 0x80), 3)
        end = 0 if word[-1:].isalnum() or word[-1] >= 0x80 else 1 if word[-1:] in b".," else 2
        return (accent * 3 + end) * 2 + (len(word) > 6)

    rng = random.Random(3)
    texts = ["", " ", "\x1c A\x0bb\x85c\xa0d", "\u00e9 \u00c9t\u00e9, \u00fcber. \u6f22\u5b57! \r\n", "Abcdef abcdefg"]
    texts += ["".join(rng.choices("aBz9.,!- \t\n\u00e9\u00df\u00fc\u00f1\u6f22\U0001f600", k=rng.randrange(80))) for _ in range(300)]
    want = [t.encode().lower().split() for t in texts]
    words, edges = gru.words_of(pa.array(texts))
    assert [words[a:b].to_pylist() for a, b in zip(edges.tolist(), edges.tolist()[1:])] == want
    assert gru.look(words).tolist() == [plain(w) for w in itertools.chain(*want)]
    assert gru.look(words[5:]).tolist() == gru.look(words).tolist()[5:]
    known = gru.Words([(b"w0", 9), (b"w1", 8)], 17, 2, 1, {}, gru.LEAST_SIDE)
    calls, many = [], pa.array([" ".join(f"W{i}" for i in range(5000))] * 2)
    sys.setprofile(lambda frame, event, arg: calls.append(frame) if event == "call" else None)
    try:
        each, edges = gru.words_of(many)
        tokens, ranks = known.tokens(each)
    finally:
        sys.setprofile(None)
    assert len(calls) < 500  # one for each rare word before
    assert edges.tolist() == [0, 5000, 10_000] and ranks.tolist() == [0, 1, *[-1] * 4998] * 2
    assert tokens.tolist() == [i if i < 2 else known.end + 1 for i in range(5000)] * 2


def test_lm_slices_keep_all_rows():
    texts = ["a" * n for n in (0, 5, 30, 0, 3, 3, 50, 1)] + [None, "b"]
    got = list(gru.slices(iter([pa.record_batch({"text": texts}), pa.record_batch({"text": pa.array([], pa.string())})]), most=10))
    assert [t for b in got for t in b.column("text").to_pylist()] == texts and len(got) > 3 and all(len(b) for b in got)


def test_gru_outputs_in_blocks_and_held(monkeypatch):
    rng = np.random.default_rng(4)
    m = gru.Gru.start(np.ones(gru.HEAD) * 5, np.ones(gru.LOOKS) * 50)
    for size in (0.1, 40):  # logits of the second pass 60 and are held
        m.classes[:], m.words[:] = rng.normal(0, size, m.classes.shape), rng.normal(0, size, m.words.shape)
        states, x = rng.uniform(-1, 1, (100, gru.HIDDEN)).astype(np.float32), rng.integers(0, gru.HEAD + gru.LOOKS, 100)
        whole, (by_state, d) = m.outputs(states, x), m.outputs(states, x, back=True)
        logits = np.clip(states.astype(np.float64) @ m.classes[:-1] + m.classes[-1], -60, 60)
        cls = np.where(x < gru.HEAD, x // gru.LEAST_SIDE, gru.LEAST_SIDE + x - gru.HEAD)
        want = logits[np.arange(100), cls] - np.log(np.exp(logits).sum(axis=1))
        inner = np.clip(np.einsum("nk,nkw->nw", states.astype(np.float64), m.words[np.minimum(cls, gru.LEAST_SIDE - 1), :-1]) + m.words[np.minimum(cls, gru.LEAST_SIDE - 1), -1], -60, 60)
        want += np.where(x < gru.HEAD, inner[np.arange(100), x % gru.LEAST_SIDE] - np.log(np.exp(inner).sum(axis=1)), 0)
        assert np.allclose(whole, want, rtol=1e-4, atol=1e-4)
        monkeypatch.setattr(gru, "ROWS_AT_ONCE", 7)
        assert np.allclose(m.outputs(states, x), whole, rtol=1e-5, atol=1e-5)
        blocks = m.outputs(states, x, back=True)
        monkeypatch.undo()
        assert np.allclose(blocks[0], by_state, rtol=1e-3, atol=1e-3) and all(np.allclose(blocks[1][k], d[k], rtol=1e-3, atol=1e-3) for k in d)
    empty = m.outputs(np.zeros((0, gru.HIDDEN), dtype=np.float32), np.zeros(0, dtype=int))
    assert len(empty) == 0


# ---- 6: mixing

@pytest.mark.parametrize("weights", [[1], [3, 1], [8, 6, 5, 4, 4, 3, 3, 2, 2, 1, 12], [1, 1, 1], [7, 5, 3, 2]])
def test_pfair_windows(weights):
    slots, total = mixing.pfair(weights), sum(weights)
    assert sorted(itertools.chain(*slots)) == list(range(total))
    for w, own in zip(weights, slots):
        for k, t in enumerate(own):
            assert k * total // w <= t < -(-(k + 1) * total // w)
        for t in range(total + 1):
            assert abs(sum(s < t for s in own) - t * w / total) < 1


def test_mixing_edge_cases(make_docs, mixed_rows):
    rows = [(d, t, "en", [None, "a", "b", "c"][i % 4]) for i, (d, t) in enumerate(mixed_rows)]
    docs = make_docs(rows).withColumn("mix_slot", F.lit("old"))
    got = mixing.mix(docs, {"a": 2, "b": 1}, 3, block_chars=500, cell_rows=5)
    plain = mixing.mix(docs, {"a": 2, "b": 1}, 3, block_chars=500).collect()
    assert got.columns == [*(c for c in docs.columns if c != "mix_slot"), "mix_source", "mix_start", "mix_block", "mix_slot"]
    key = lambda r: (str(r["doc_id"]), r["mix_source"], r["mix_start"], r["mix_slot"])
    got = got.collect()
    assert sorted(map(key, got)) == sorted(map(key, plain)) and len(got) == len(rows)
    for source in ("a", "b", "*"):
        at = 0
        for r in sorted((r for r in got if r["mix_source"] == source), key=lambda r: (r["mix_start"], len(r["text"] or ""))):
            assert r["mix_start"] == at and r["mix_block"] == at // 500
            at += len(r["text"] or "")
    assert mixing.mix(make_docs([]), {}, 1).count() == 0


# ---- 7: token counts

def unigram():
    from tokenizers import Tokenizer, models, pre_tokenizers

    t = Tokenizer(models.Unigram(viterbi.vocabulary(PIECES), unk_id=0, byte_fallback=False))
    t.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.Metaspace()])
    return t


def test_token_counts_are_the_tokenizers(make_docs, mixed_rows):
    t = unigram()
    rows = mixed_rows + [(900 + i, x) for i, x in enumerate(["日本語 a日b", "a▁b ▁▁", "<unk> x", "\x1c a\x1cb \x85z", "☃☃☃x☃", "a b c", "aaaaaaaaaaab" * 30])]
    got = viterbi.token_counts(make_docs(rows), PIECES).collect()
    want = collections.Counter((d, len(t.encode(x or "").ids)) for d, x in rows)
    assert collections.Counter((r["doc_id"], r["n_tokens"]) for r in got) == want
    assert viterbi.token_counts(make_docs([]), PIECES).count() == 0


def test_ties_go_to_the_longest_last_piece():
    c = viterbi.Counter([("<unk>", 0.0), ("a", -1.0), ("aa", -2.0), ("b", -1.0)])
    assert c.best("aa") == (1, -2.0) and c.best("aaa") == (2, -3.0)
    assert c.best("a??b")[0] == 3


# ---- 8: nearest neighbours

def test_neighbours_recall_and_edge_cases(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(900, 16)).astype(np.float32)
    x[100:140] = x[100]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(1000, None), (1050, [0.0] * 16), (1100, [float("nan")] * 16), (None, x[0].tolist()), (1150, [None] + [1.0] * 15), (1200, [float("inf")] * 16), (1250, [1.0])]
    df = spark.createDataFrame(rows + odd + [rows[3]], "vec_id long, embedding array<float>").withColumn("rank", F.lit(0)).withColumn("score", F.lit(0))
    got = ann.neighbours(df, F.col("vec_id") % 50 == 0, shard_rows=300, block_queries=7, pivots=128, prefix=64, share=0.3).collect()
    unit = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    hits = n = 0
    for q in range(0, 900, 50):
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        assert [m[0] for m in mine] == [1, 2, 3, 4, 5]
        s = np.round(unit @ unit[q], 12)
        s[q] = -9
        hits += len({m[1] for m in mine} & set(np.lexsort((np.arange(900), -s))[:5].tolist()))
        n += 5
        assert all(abs(m[2] - unit[m[1]] @ unit[q]) < 1e-12 for m in mine)
    assert {r["query_id"] for r in got} == set(range(0, 900, 50)) and hits / n >= 0.9
    assert [r["vec_id"] for r in got if r["query_id"] == 100] == [101, 102, 103, 104, 105]
    assert ann.neighbours(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    few = ann.neighbours(df.where("vec_id < 3"), F.col("vec_id") % 50 == 0).collect()
    assert sorted(r["vec_id"] for r in few) == [1, 2]


# ---- 9: quality rules

def rules_brute(text):
    text = text or ""
    words = WORD(text)
    windows = collections.Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    covered = {i + j for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for j in range(5)}
    lines = [x for x in text.split("\n") if WORD(x)]
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), n < 10 or 100 * len(covered) > 20 * n)


def test_rules_against_brute_force(make_docs, mixed_rows):
    rng = random.Random(4)
    rows = [(*r, lang) for r, lang in zip(mixed_rows, itertools.cycle(["en", None, "xx"]))]
    lines = ["a b c d e f g h i j k\n" * 3 + "z # $ |", "x\n\n \nx\r\nx", "<|*%&>" * 9 + " é☃ ü", " ".join("ab cd ef gh ij kl".split() * 9) + " q r s t u"]
    rows += [(2000 + i, t, "en") for i, t in enumerate(lines)]
    rows += [(3000 + i, " ".join(rng.choice("the of and to in a is that it for word other text".split()) for _ in range(300)), "en") for i in range(40)]
    docs = make_docs([(d, t, lang, "s") for d, t, lang in rows])
    got = rules.judged(docs).collect()
    pick = lambda r: (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"])
    assert collections.Counter((r["doc_id"], pick(r)) for r in got) == collections.Counter((d, rules_brute(t)) for d, t, _ in rows)
    assert not any(r["kept"] and r["base_failed"] for r in got)
    assert rules.judged(make_docs([])).count() == 0


def test_distance_is_jensen_shannon(spark):
    df = spark.createDataFrame([([3, 1, 0], [1, 1, 2]), ([1, 2, 3], [1, 2, 3]), ([0, 0, 0], [1, 2, 3])], "a array<long>, b array<long>")
    got = [r[0] for r in df.select(rules.distance(F.col("a"), F.col("b"))).collect()]
    p, q = np.array([3, 1, 0]) / 4, np.array([1, 1, 2]) / 4
    kl = lambda a, b: sum(x * math.log2(x / y) for x, y in zip(a, b) if x)
    assert got[0] == pytest.approx(math.sqrt((kl(p, (p + q) / 2) + kl(q, (p + q) / 2)) / 2)) and got[1] == pytest.approx(0, abs=1e-6) and got[2] == 0


def test_rules_keep_clean_documents(spark):
    got = rules.judged(spark.read.parquet("/root/testdata/sf0.1/documents.parquet")).join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id").where("not base_failed").collect()
    good = [r["kept"] for r in got if r["quality"] == 1]
    bad = [r["kept"] for r in got if r["quality"] == 0]
    assert np.mean(good) > 0.99 and np.mean(bad) < 0.3


# ---- 10: licenses

def licenses_brute(rows, least=0.6):
    _, known = licenses.template_counts(licenses.TEMPLATES)
    units, n = [], 0
    for i, (_, text) in enumerate(rows):
        for line in re.split("[\r\n]+", text or ""):
            n += 1
            c = collections.Counter(w for w in re.findall("[a-z0-9]+", line.lower()) if w not in licenses.STOP_WORDS)
            units.append((i, c))
    df = collections.Counter(w for _, c in units for w in c)
    idf = lambda w: math.log((1 + n) / (1 + df.get(w, 0))) + 1
    best = {}
    for i, c in units:
        norm = math.sqrt(sum((k * idf(w)) ** 2 for w, k in c.items()))
        for name, t in known:
            cos = sum(c[w] * t[w] * idf(w) ** 2 for w in t) / math.sqrt(sum((k * idf(w)) ** 2 for w, k in t.items())) / norm if norm else 0
            if cos > 0:
                best[i] = min(best.get(i, (0, "")), (-round(cos, 9), name))
    return {i: name for i, (cos, name) in best.items() if -cos >= least}


def test_licenses_and_inheritance(spark):
    gpl, mit = licenses.TEMPLATES["GPL-3.0"][0], licenses.TEMPLATES["MIT"][0]
    rng = random.Random(6)
    rows = [("/a/LICENSE", gpl), ("/a/b/COPYING.txt", mit + "\n" + prose(rng, 200)), ("/a/b/c/x.py", "print"), ("/a/z.py", prose(rng, 50)),
            ("/a/b/y.py", "Licensed under the Apache License, Version 2.0.\n" + prose(rng, 300)), ("/q/w.py", prose(rng, 9)), ("/q/e/r.py", None),
            (None, "x"), ("/q/e/r.py", ""), ("top.py", "a license of the work"), ("/a/ab/k.py", "k"), ("/q/many.txt", "\n".join([mit, "word " * 3, gpl.upper()]))]
    files = spark.createDataFrame([(i, p, t, "own", 1.0) for i, (p, t) in enumerate(rows)], "n int, path string, text string, license string, similarity double")
    got = {r["n"]: r for r in licenses.inherited(licenses.scanned(files)).collect()}
    assert len(got) == len(rows)
    assert {i: r["own_license"] for i, r in got.items() if r["own_license"]} == licenses_brute(rows)
    want = {0: ("GPL-3.0", None), 1: ("MIT", None), 2: ("MIT", "/a/b"), 3: ("GPL-3.0", "/a"), 4: ("Apache-2.0", None), 5: (None, None), 6: (None, None), 7: (None, None), 8: (None, None), 10: ("GPL-3.0", "/a")}
    want[5] = want[6] = want[8] = (got[11]["own_license"], "/q") if got[11]["licence_file"] else (None, None)
    want[6] = want[8] = want[5]
    for i, (license, origin) in want.items():
        assert (got[i]["license"], got[i]["inherited_from"]) == (license, origin), i
    assert licenses.inherited(licenses.scanned(files.limit(0))).count() == 0


# ---- the registered queries

def test_license_words_count_by_their_lines(spark):
    rng, word = random.Random(4), re.compile("[a-z0-9]+").findall
    heads = ["# Copyright 2021 Acme Inc. Licensed under the Apache License, Version 2.0.", "All files here, all of them, are Licensed under CC BY 4.0.", "copyright acme inc license license"]
    texts = [f"{heads[i % 3]}\n{prose(rng, 12)}\r\ncopyright acme {prose(rng, 3)}" for i in range(90)] + ["files\nfolder work", None]
    lines = [[w for w in word(x.lower()) if w not in licenses.STOP_WORDS] for t in texts for x in re.split("[\r\n]+", t or "")]
    df = collections.Counter(w for x in lines for w in set(x))
    vector = lambda c: {w: n * (math.log((1 + len(lines)) / (1 + df[w])) + 1) for w, n in c.items()}
    norm = lambda v: math.sqrt(sum(x * x for x in v.values()))
    known = [vector(c) for _, c in licenses.template_counts(licenses.TEMPLATES)[1]]
    got = {r["n"]: r for r in licenses.scanned(spark.createDataFrame([(i, str(i), t) for i, t in enumerate(texts)], "n int, path string, text string")).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        vectors = [vector(collections.Counter(w for w in word(x.lower()) if w not in licenses.STOP_WORDS)) for x in re.split("[\r\n]+", t or "")]
        want = max(sum(v[w] * k[w] for w in v.keys() & k.keys()) / norm(v) / norm(k) if v else 0 for v in vectors for k in known)
        assert math.isclose(got[i]["similarity"], want, abs_tol=1e-8), (i, t)
        assert (got[i]["own_license"] is not None) == (want >= 0.6)
    assert got[0]["own_license"] == "Apache-2.0"


def test_queries_are_registered():
    import __spark_entry__ as e

    names = e.queries()
    for n in range(1, 11):
        assert any(re.match(rf"op{n}_", x) for x in names)
    assert "pipeline" in names


def test_sql_of_the_mixture(spark):
    import duckdb

    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{SF}/documents.parquet'")
    want = con.sql(queries.ORACLES["op6_mixing_sources"]).fetchall()
    assert sorted(map(tuple, queries.mixing_sources(spark, SF).collect())) == sorted(want)


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for i, (name, stage) in enumerate(p.STAGES):
        was, docs = docs, stage(spark, docs, SF)
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if i + 1 < len(p.STAGES):
            assert docs.columns == was.columns
            assert docs.select("doc_id").subtract(was.select("doc_id")).count() == 0
        before, now = {r["doc_id"]: r["text"] for r in was.collect()}, docs.collect()
        if name == "quality":
            labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
            gone = before.keys() - {r["doc_id"] for r in now}
            assert gone and np.mean([labels[d] == 0 for d in gone if d in labels]) > 0.9
        if name == "near_copies":
            assert {r["doc_id"] for r in now} == {c for _, c, _ in jaccard_brute(list(before.items()))}
        if name == "repeats":
            want = {r[0]: r[2] for r in suffix_brute(list(before.items()))}
            assert all((r["text"] == before[r["doc_id"]]) == (want[r["doc_id"]] == 0) for r in now)
        if name == "mixture":
            assert {r["doc_id"]: r["text"] for r in now} == before
        if name == "packed":
            assert {r["doc_id"] for r in now} == before.keys()
