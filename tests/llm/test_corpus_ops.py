"""Decontamination, near duplicates, passages, quality, language model and the pipeline against plain versions."""

import itertools
import math
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from scriptoria.llm import common, decontaminate, graph, neardup, passages, ppm, quality

VOCABULARY = [a + b + c for a in ("ba", "ko", "mi", "tu", "re", "lo") for b in ("na", "si", "do", "ve", "") for c in ("r", "n", "st", "x")]


def prose(rng, n):
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


# --- words


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text("abC ,.éÉß“İ1\n", max_size=40) | st.none(), max_size=5))
def test_word_hashes(texts):
    hasher = common.WordHasher()
    hashes, at = hasher(texts)
    words = [common.normal_words(t) for t in texts]
    assert np.diff(at).tolist() == [len(w) for w in words] if texts else True
    flat = [w for ws in words for w in ws]
    seen = {}
    for h, w in zip(hashes.tolist(), flat, strict=True):
        assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)
    for t in texts:
        cut = [(t or "")[b:e] for b, e in passages.word_offsets(t)]
        assert [c.replace("İ", "i").lower().encode() for c in cut] == common.normal_words(t)


# --- decontamination


def plain_scores(index, terms):
    present = set(terms[terms >= 0].tolist())
    out = np.zeros(len(index.items))
    for t in present:
        lo, hi = index.posting_from[t], index.posting_from[t + 1]
        out[index.posting_item[lo:hi]] += index.posting_impact[lo:hi]
    return out


def test_block_max_wand_finds_all():
    rng = random.Random(2)
    items = [(i, prose(rng, rng.randint(5, 40))) for i in range(150)]
    index, hasher = decontaminate.ItemIndex(items), common.WordHasher()
    for k in range(200):
        text = prose(rng, 60) if k % 3 else items[rng.randrange(150)][1] + " " + prose(rng, 10)
        terms = index.lookup(hasher([text])[0])
        scores = plain_scores(index, terms)
        for threshold in (0.15, 0.4, 0.9):
            got = dict(index.search(terms, threshold))
            assert set(got) == set(np.flatnonzero(scores >= threshold - 1e-9).tolist())
            assert all(math.isclose(got[i], scores[i]) for i in got)
        screened = index.windows_above(terms, np.ones(len(terms), np.int64), 0.6)
        assert not (scores >= 0.6).any() or 1 in screened


def test_contaminated(spark):
    rng = random.Random(3)
    items = [(i, prose(rng, 30) + ". " + prose(rng, 12) + ".") for i in range(20)] + [(None, prose(rng, 25)), (77, ""), (78, None)]
    whole = lambda i: items[i][1]
    docs = [(0, prose(rng, 300)), (1, prose(rng, 200) + "\n" + whole(3).upper().replace(" ", "  ") + " " + prose(rng, 90)), (2, None), (3, ""), (4, whole(5)), (4, whole(5)), (None, whole(20) + " x"), (5, whole(6).split(". ")[0]), (6, prose(rng, 60_000) + " " + whole(7) + " " + whole(8)), (7, "...")]
    d = spark.createDataFrame([(*x, "clash") for x in docs], "doc_id long, text string, item_id string")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(((r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(d, b).collect()), key=str)
    assert got == sorted([(1, 3), (4, 5), (4, 5), (None, None), (6, 7), (6, 8)], key=str)
    kept = decontaminate.without_contaminated(d, b)
    assert kept.columns == d.columns and sorted(r["doc_id"] for r in kept.collect()) == [0, 2, 3, 5, 7]
    assert decontaminate.contaminated(d.limit(0), b).count() == decontaminate.contaminated(d, b.limit(0)).count() == 0
    assert decontaminate.without_contaminated(d, b.limit(0)).count() == len(docs)
    shards = list(decontaminate.index_shards(b, "item_id", "text", 1500))
    assert len(shards) > 3 and sum(len(i.items) for s in shards for i in s) == 21


def test_shards_and_lengths_change_no_result(spark):
    """Against all items scored one by one with the statistics of all: whatever the shards, and beside one very long item."""
    rng = random.Random(31)
    items = [(i, prose(rng, rng.randint(20, 40)) + ". " + prose(rng, 8) + ".") for i in range(40)] + [(100, prose(rng, 3000)), (101, prose(rng, 90))]
    docs = [(i, prose(rng, 50)) for i in range(10)]
    for i, text in items:
        words = text.split()
        for at in rng.sample(range(len(words)), len(words) // rng.choice((8, 15, 40))):
            words[at] = rng.choice(VOCABULARY)
        docs.append((1000 + i, f"{prose(rng, rng.randint(0, 80))} {' '.join(words)} {prose(rng, 30)}"))
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    index, hasher = decontaminate.ItemIndex(items), common.WordHasher()
    want = set()
    for doc_id, text in docs:
        words = hasher([text])[0]
        for i, item in enumerate(index.items):
            n = 64 if len(item.words) < 64 else 256 if len(item.words) < 256 else 4096
            group = [x for x in index.items if len(x.words) < n and len(x.words) * 4 >= n] if n > 64 else [x for x in index.items if len(x.words) < 64]
            stride = max(len(x.words) for x in group)
            for at in range(0, max(1, len(words)), stride):
                passage = words[at : at + 2 * stride]
                score = plain_scores(index, index.lookup(passage))[i]
                q, a = (decontaminate.overlap(part, passage) for part in (item.question, item.answer))
                if score >= decontaminate.THRESHOLD and decontaminate.present(item, passage, q, a, decontaminate.OVERLAP):
                    want.add((doc_id, item.item_id))
    assert len(want) > 25
    scores = []
    for shard_bytes in (1 << 20, 3000):
        got = decontaminate.contaminated(d, b, shard_bytes=shard_bytes).collect()
        assert {(r["doc_id"], r["item_id"]) for r in got} == want
        scores.append(sorted((r["doc_id"], r["item_id"], round(r["score"], 9)) for r in got))
        assert decontaminate.without_contaminated(d, b, shard_bytes=shard_bytes).count() == len(docs) - len({x for x, _ in want})
    assert scores[0] == scores[1]


# --- near duplicates


def plain_aligned(a, b):
    table = np.zeros((len(a) + 1, len(b) + 1), int)
    for i, j in itertools.product(range(len(a)), range(len(b))):
        table[i + 1, j + 1] = table[i, j] + 1 if a[i] == b[j] else max(table[i, j + 1], table[i + 1, j])
    common_ = table[-1, -1]
    return common_ / (len(a) + len(b) - common_) if len(a) + len(b) else 1.0


@settings(max_examples=150, deadline=None)
@given(st.permutations(range(14)), st.lists(st.tuples(st.integers(0, 14), st.integers(100, 110)), max_size=3))
def test_alignment(order, edits):
    a = np.arange(14, dtype=np.uint64)
    b = list(order) if len(edits) == 3 else list(range(14))
    for at, value in edits:
        b[at:at] = [value] if value not in b else []
    b = np.array(b, np.uint64)
    exact = plain_aligned(a.tolist(), b.tolist())
    assert neardup.aligned(a, b) == pytest.approx(exact if exact >= 0.8 - 1e-12 else 0.0)


def near_fixture(rng):
    docs = [(i, prose(rng, 120)) for i in range(30)]
    for i in range(8):
        words = docs[i][1].split()
        for _ in range(1 + i % 3):
            words[rng.randrange(len(words))] = "changed"
        docs.append((100 + i, " ".join(words).upper()))
    chain = prose(rng, 200).split()
    for k in range(6):
        chain = [*chain[: 30 * k], f"new{k}", *chain[30 * k + 1 :]]
        docs.append((200 + k, " ".join(chain)))
    docs += [(300, None), (301, ""), (302, "..."), (303, "one two"), (304, "One, two!"), (305, "one three"), (306, "..."), (307, docs[0][1]), (0, docs[0][1]), (None, docs[1][1]), (None, prose(rng, 50)), (308, prose(rng, 30_000))]
    shuffled = docs[9][1].split()
    docs.append((309, " ".join(shuffled[60:] + shuffled[:60])))
    return docs


def plain_classes(docs):
    hasher = common.WordHasher()
    texts = [t or "" for _, t in docs]
    shingles = [neardup.labelled_shingles(hasher([t])[0]) for t in texts]
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in itertools.combinations(range(len(docs)), 2):
        if texts[i] == texts[j] or (len(shingles[i]) and len(shingles[j]) and neardup.aligned(shingles[i], shingles[j]) > 0):
            root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(docs))]


def test_near_duplicates(spark):
    docs = near_fixture(random.Random(4))
    df = spark.createDataFrame([(*d, "clash", {"k": "v"}) for d in docs], "doc_id long, text string, class_id string, m map<string,string>")
    expected = plain_classes(docs)
    ids = {}
    for c, (i, _) in zip(expected, docs, strict=True):
        ids.setdefault(c, []).append(i)
    want = sorted(((i, min((x for x in ids[c] if x is not None), default=None), len(ids[c])) for c, (i, _) in zip(expected, docs, strict=True)), key=str)
    assert sorted(map(tuple, neardup.classes(df).collect()), key=str) == want
    kept = neardup.keep_one(df)
    assert kept.columns == df.columns and kept.count() == len(ids)
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted((min((x for x in v if x is not None), default=None) for v in ids.values()), key=str)
    assert neardup.classes(df.limit(0)).count() == neardup.keep_one(df.limit(0)).count() == 0


def test_components(spark):
    rng = random.Random(6)
    links = [(rng.randrange(80), rng.randrange(80)) for _ in range(60)] + [(1000 + i, 1001 + i) for i in range(40)] + [(5, 5)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        if a != b:
            root[max(find(a), find(b))] = min(find(a), find(b))
    for bound in (1000, 10):  # in one task, and by stars
        got = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(links, "a long, b long"), bound).collect()}
        assert got == {x: find(x) for x in list(root)}
        assert graph.components(spark.createDataFrame([], "a long, b long"), bound - 10).count() == 0


# --- passages


def test_repeated_passages(spark):
    rng = random.Random(7)
    shared, brief = prose(rng, 70), prose(rng, 49)
    docs = [(i, prose(rng, rng.randint(0, 150))) for i in range(12)]
    docs += [(20 + i, f"{prose(rng, 40)} {shared.upper()}, {prose(rng, 30)}") for i in range(9)] + [(40, brief + " q " + prose(rng, 60)), (41, prose(rng, 60) + " p " + brief)]
    docs += [(50, docs[-1][1] + " " + docs[3][1] + " " + prose(rng, 80)), (60, None), (61, ""), (62, "short"), (62, "short"), (63, prose(rng, 55)), (None, prose(rng, 100))]
    docs += [(64, docs[-2][1]), (65, prose(rng, 50_000) + " " + shared), (66, (prose(rng, 60) + " ") * 2)]
    df = spark.createDataFrame([(*d, "clash") for d in docs], "doc_id long, text string, start_word string")
    words = [common.normal_words(t) for _, t in docs]
    holders = {}
    for (_, t), w in zip(docs, words, strict=True):
        for i in range(len(w) - 49):
            holders.setdefault(tuple(w[i : i + 50]), set()).add(t)
    texts = [t or "" for _, t in docs]
    want = []
    for (i, t), w in zip(docs, words, strict=True):
        if texts.count(t or "") > 1 and len(w) >= 50:
            want.append((i, 0, len(w), len(w), True))
            continue
        starts = [k for k in range(len(w) - 49) if len(holders[tuple(w[k : k + 50])]) > 1]
        inside = {k + j for k in starts for j in range(50)}
        edges = [k for k in sorted(inside) if k - 1 not in inside]
        for b in edges:
            e = next(x for x in itertools.count(b) if x not in inside)
            want.append((i, b, e, e - b, False))
    got = passages.repeated_passages(df).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str) and len(want) > 10
    assert passages.repeated_passages(df.limit(0)).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(1, 3), max_size=14), min_size=1, max_size=8), st.lists(st.integers(0, 80), max_size=4), st.integers(1, 40), st.integers(1, 7))
def test_neighbours_over_parts_and_batches(texts, parts, chunk, batch):
    """Short passages of few words, all suffixes retained: however the sorted rows are cut, exactly the passages that another text has are found."""
    import pyarrow as pa

    with pytest.MonkeyPatch.context() as patch:
        for name, value in (("MIN_WORDS", 5), ("GRAM_WORDS", 3), ("REACH", 2), ("CHUNK_ROWS", chunk)):
            patch.setattr(passages, name, value)
        distinct = [np.array(t, ">u4") for t in sorted(set(map(tuple, texts)))]
        ordered = sorted((w[at : at + 5].tobytes(), w[:at][::-1][:2].tobytes(), n % 3, n, at) for n, w in enumerate(distinct) for at in range(len(w) - 2))
        cuts = sorted({0, len(ordered), *(min(p, len(ordered)) for p in parts)})
        told = []
        for lo, hi in itertools.pairwise(cuts):
            frames = [pa.RecordBatch.from_arrays([pa.array([r[k] for r in ordered[b : min(b + batch, hi)]], t) for k, t in enumerate((pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int32()))], list("abcde")) for b in range(lo, hi, batch)]
            told += [r for f in passages._neighbours(iter(frames)) for r in f.to_pylist()]
    ends = {}
    for r in told:
        if r["kind"] == 1:
            ends.setdefault((r["k1"], r["k2"]), set()).update([(0, r["n1"]), (0, r["m1"]), (1, r["n2"]), (1, r["m2"])])
    shared = {k for k, v in ends.items() if len(v) > 2}
    got = {(r["n2"], r["start"]) for r in told if r["kind"] == 0 or r["kind"] == 2 and (r["k1"], r["k2"]) in shared}
    holders = {}
    for n, w in enumerate(distinct):
        for k in range(len(w) - 4):
            holders.setdefault(w[k : k + 5].tobytes(), set()).add(n)
    assert got == {(n, k) for n, w in enumerate(distinct) for k in range(len(w) - 4) if len(holders[w[k : k + 5].tobytes()]) > 1}


# --- quality


def graded_docs(rng, n):
    out = []
    for i in range(n):
        kind = rng.choice([0, 1, 2, 2, 2])
        words = prose(rng, rng.randint(30, 200)).split()
        if kind == 0:
            for _ in range(3):
                words[rng.randrange(len(words))] = rng.choice(["vile", "nasty", "foul"])
        if kind == 1:
            words = [w + "%%%" for w in words]
        out.append((i, " ".join(words), kind))
    return out


def test_quality_on_held_out(spark):
    docs = graded_docs(random.Random(8), 600)
    df = spark.createDataFrame([(i, t, "clash") for i, t, _ in docs] + [(None, None, "x"), (9999, "", "x"), (0, docs[0][1], "x"), (8888, "word " * 300_000, "x")], "doc_id long, text string, p_good string")
    labels = spark.createDataFrame([(i, int(k == 2), int(k == 0)) for i, _, k in docs if i % 3] + [(None, 1, 1), (1, None, 0), (7777, 1, 0)], "doc_id long, quality int, toxic int")
    model = quality.train(df, quality.graded(labels))
    assert (np.diff(model.thresholds) > 0).all()
    rated = quality.score(df, model).collect()
    assert len(rated) == 604
    by_id = {r["doc_id"]: r for r in rated}
    assert all(0 <= r["p_good"] <= r["p_fair"] <= 1 and math.isclose(r["expected_grade"], r["p_good"] + r["p_fair"], abs_tol=1e-8) for r in rated)
    held = [(by_id[i], k) for i, _, k in docs if i % 3 == 0]
    assert sum((r["p_good"] >= quality.KEEP_TAIL) == (k == 2) for r, k in held) / len(held) > 0.95
    kept = quality.select(df, model)
    assert kept.columns == df.columns and kept.count() == sum(r["p_good"] >= quality.KEEP_TAIL for r in rated)
    assert quality.train(df, quality.graded(labels), sample_rows=10).weights.shape == model.weights.shape
    for nothing in (quality.train(df, quality.graded(labels.limit(0))), quality.train(df.limit(0), quality.graded(labels))):
        assert quality.select(df, nothing).count() == 604
    assert quality.score(df.limit(0), model).count() == 0


def test_fit_against_a_plain_optimiser():
    """The penalised likelihood that fit() reaches is that of plain descent with a line search, on dense rows, from other starts."""
    rng = np.random.default_rng(10)
    n, p, ridge = 200, 12, 1.0
    x = (rng.random((n, p)) < 0.4).astype(float)
    latent = x @ rng.normal(size=p) + rng.logistic(size=n)
    grades = np.digitize(latent, np.quantile(latent, [0.25, 0.6]))
    found = np.concatenate([np.flatnonzero(r) for r in x])
    begins = np.concatenate([[0], np.cumsum(x.sum(1))]).astype(int)

    def loss(w, cuts):
        below = np.concatenate([np.zeros((n, 1)), 1 / (1 + np.exp(-(cuts[None, :] - (x @ w)[:, None]))), np.ones((n, 1))], axis=1)
        return -np.log(below[np.arange(n), grades + 1] - below[np.arange(n), grades]).sum() + ridge / 2 * (w @ w)

    def value(z):
        return loss(z[:p], np.array([z[p], z[p] + math.exp(z[p + 1])]))

    z = np.concatenate([rng.normal(size=p), [-1.0, 0.0]])
    for _ in range(400):
        g = np.array([(value(z + e) - value(z - e)) / 2e-5 for e in np.eye(p + 2) * 1e-5])
        step = 1.0
        while value(z - step * g) > value(z) - 0.3 * step * (g @ g) and step > 1e-9:
            step /= 2
        z = z - step * g
    model = quality.fit(found, begins, grades, ridge=ridge)
    assert loss(model.weights[:p].astype(float), model.thresholds) < value(z) * 1.002
    assert np.allclose(model.weights[:p], z[:p], atol=0.1) and np.allclose(model.thresholds, [z[p], z[p] + math.exp(z[p + 1])], atol=0.1)
    for k in (0, 1):
        chance = 1 / (1 + np.exp(-(x @ z[:p] - [z[p], z[p] + math.exp(z[p + 1])][k])))
        assert np.allclose(model.tails(model.latent(found, begins))[:, k], chance, atol=0.03)


# --- language model


def plain_ppm(train):
    counts = {}
    for t in train:
        s = [ppm.END] * ppm.ORDER + list(ppm.lowered(t)) + [ppm.END]
        for i in range(ppm.ORDER, len(s)):
            for o in range(ppm.ORDER + 1):
                c = counts.setdefault(tuple(s[i - o : i]), {})
                c[s[i]] = c.get(s[i], 0) + 1

    def chance(context, symbol):
        out, gone = 1.0, set()
        for o in range(ppm.ORDER, -1, -1):
            seen = counts.get(tuple(context[len(context) - o :]), {})
            left = {k: v for k, v in seen.items() if k not in gone}
            t = sum(left.values())
            if symbol in left:
                return out * (2 * left[symbol] - 1) / (2 * t)
            if left:
                out *= len(left) / (2 * t)
            gone |= set(seen)
        return out / (256 - len(gone))

    return chance


@pytest.mark.parametrize("limit", [96 << 20, 0])
def test_copies_of_a_row_are_dealt_apart(spark, monkeypatch, limit):
    """Many copies of one row go to several tasks, whose model is that of one task."""
    docs = [(7, "same words here again")] * 900 + [(i, f"other words {i} here") for i in range(30)] + [(None, None)] * 120
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    learn = F.coalesce(F.col("doc_id"), F.lit(0)) % 3 != 2
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        told = lambda rows: sorted(repr((*r[:5], round(r[5], 8), round(r[6], 8))) for r in rows)
        whole = told(ppm.score_documents(df, learn, broadcast_bytes=limit).collect())
        monkeypatch.setattr(ppm, "BLOCK_COPIES", 50)
        apart = ppm.score_documents(df, learn, broadcast_bytes=limit).withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len({r["task"] for r in apart if r["doc_id"] == 7}) > 1
    assert told(apart) == whole


def test_ppm_against_a_plain_model(spark):
    rng = random.Random(9)
    docs = [(i, " ".join(rng.choice(["Abra", "cad", "ABRA", "é", "x\ty", "zz\x00"]) for _ in range(rng.randint(0, 25)))) for i in range(40)] + [(None, None), (41, ""), (5, "again"), (5, "again"), (42, "ñandú" * 3)]
    df = spark.createDataFrame([(*d, "clash") for d in docs], "doc_id long, text string, score string")
    learn = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 1
    held = lambda i: i is None or zlib.crc32(str(i).encode()) % 5 == 1
    train = [t or "" for i, t in docs if not held(i)]
    words = lambda t: [*(t or "").encode().lower().split(), None]
    counts = {}
    for w in itertools.chain.from_iterable(map(words, train)):
        counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()), len(counts)
    chance = plain_ppm(train)
    want = []
    for i, t in docs:
        s = [ppm.END] * ppm.ORDER + list(ppm.lowered(t)) + [ppm.END]
        score = sum(math.log10(chance(s[k - ppm.ORDER : k], s[k])) for k in range(ppm.ORDER, len(s)))
        base = sum(math.log10((counts.get(w, 0) + 0.5) / (n + 0.5 * (v + 1))) for w in words(t))
        want.append((i, held(i), len(words(t)), sum(w in counts for w in words(t)), n, round(base, 6), round(score, 6)))
    for limit in (1 << 20, 0):  # the model sent to the tasks, and asked for by blocks
        got = [(r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6), round(r["score"], 6)) for r in ppm.score_documents(df, learn, broadcast_bytes=limit).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
    nothing = ppm.score_documents(df, F.lit(False)).where("doc_id = 41").first()
    assert nothing["train_tokens"] == 0 and math.isclose(nothing["score"], math.log10(1 / 256))
    assert ppm.score_documents(df.limit(0), learn).count() == 0


def test_ppm_compresses_held_out(spark, small):
    """Below 3 bits a byte on documents that are not learnt from; without context, bytes take more than 4. The base score is no code: it spells no unknown word."""
    from scriptoria.llm.queries import op9_ppm

    size = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", (F.octet_length("text") + 1).alias("n"))
    sums = op9_ppm(spark, small).where("held_out").join(size, "doc_id").agg(F.sum("score"), F.sum("n")).first()
    assert 0 < -sums[0] * math.log2(10) / sums[1] < 3


# --- pipeline


def test_pipeline(spark, small):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{small}/documents.parquet")
    n = docs.count()
    extra = docs.withColumn("__mark", F.lit("x"))
    for name, stage in p.STAGES[:-1]:
        out = stage(spark, docs, small)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        assert stage(spark, extra, small).columns == extra.columns
        assert stage(spark, docs.limit(0), small).count() == 0
        nulls = docs.limit(3).select(*(F.lit(None).cast(k).alias(c) for c, k in docs.dtypes))
        stage(spark, docs.union(nulls), small).count()
    kept = [r["doc_id"] for r in p.run(spark, small).select("doc_id").distinct().collect()]
    assert 0.5 * n < len(kept) < n
    model = quality.train(docs, quality.graded(spark.read.parquet(f"{small}/labels.parquet")))
    good = {r["doc_id"] for r in quality.score(docs, model).where(F.col("p_good") >= quality.KEEP_TAIL).collect()}
    rows = [(r["doc_id"], r["text"]) for r in docs.orderBy("doc_id").collect() if r["doc_id"] in good]
    firsts = {}
    for c, (i, t) in zip(plain_classes(rows), rows, strict=True):
        firsts.setdefault(c, (i, t))
    items = [common.normal_words(r["text"]) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    clean = [i for i, t in firsts.values() if not any(b" ".join(x) in b" ".join(common.normal_words(t)) for x in items)]
    assert sorted(kept) == sorted(clean)
