"""Spelling variants, whitening and the parity join against brute force, and their edge cases."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tableforge.llm import fm_index, parity_join, spelling, whitening

SF = "/root/testdata/sf0.01"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ODD = "doc_id long, text string, lang string, source string, word string, node string"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty, long and repeated texts, null and repeated ids, columns whose names clash with results."""
    many = " ".join(f"w{i}" for i in range(40))
    texts = [None, "", " \n\t", "one", "a b c d", many, many, many + " w40", many.upper(), "Größe größe GRÖSSE Straße straßen ÿÿÿÿÿ " * 3, "lettre lettres letter lettar " * 5, "long words of a very long text " * 20_000, "a b c d"]
    rows = [(i, t, "en", None if i == 3 else "h", "x", "y") for i, t in enumerate(texts)] + [(None, many + " w41", "en", "h", "x", "y"), (5, "another text of a repeated id", "en", "h", "x", "y")]
    return spark.createDataFrame(rows, ODD).repartition(3)


# --- spelling variants ---


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def variants_by_hand(rows):
    """word to (form, root, n, n_near, form_n), word by word."""
    counts = Counter()
    for name, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if name is None else name}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    shorter = defaultdict(set)
    for w in words:
        for i in range(len(w)):
            shorter[w[:i] + w[i + 1 :]].add(w)
    near = {w: {x for c in [w, *(w[:i] + w[i + 1 :] for i in range(len(w)))] for x in shorter[c] | ({c} & words.keys()) if x != w and one_apart(x, w)} for w in words}
    top = {w: min(near[w], key=lambda x: (-words[x], x)) if near[w] else None for w in words}
    form = {w: t if t and words[t] >= 2 * words[w] else None for w, t in top.items()}

    def root(w):
        return root(form[w]) if form[w] else w

    return {w: (form[w], root(w), n, len(near[w]), words[form[w]] if form[w] else None) for w, n in words.items()}


def test_search_schemes():
    """Every word at one error, by the search that its exact half asks for, on alphabets small and large."""
    rng = random.Random(5)
    for k in range(30):
        letters = ["ab", "abcdef", "aéÿ"][k % 3].encode("latin-1")
        words = list({bytes(rng.choice(letters) for _ in range(rng.randint(1, 7))) for _ in range(70)})
        rng.shuffle(words)
        asked = words + [bytes(rng.choice(b"abz") for _ in range(rng.randint(1, 6))) for _ in range(20)]
        index = fm_index.Index(words)
        for right in (True, False):
            q, w = fm_index.one_error(index, asked, right)
            found = list(zip(q.tolist(), w.tolist(), strict=True))
            half = lambda a, b: b.startswith(a[: len(a) // 2]) if right else b.endswith(a[len(a) // 2 :])  # noqa: B023, E731
            assert sorted(found) == [(i, j) for i, a in enumerate(asked) for j, b in enumerate(words) if one_apart(a, b) and half(a, b)]
    assert len(fm_index.one_error(fm_index.Index([b"abcde"]), [], True)[0]) == 0


def test_suffix_order_and_intervals():
    text = np.frombuffer(b"\0banana\0bandana\0", np.uint8)
    raw = text.tobytes()
    assert fm_index.suffix_order(text).tolist() == sorted(range(len(raw)), key=lambda i: raw[i:])
    index = fm_index.Index([b"banana", b"bandana"])
    state = index.all(1)
    for symbol, right in ((b"n", True), (b"a", True), (b"a", False), (b"d", False)):
        state = index.grow(state, np.frombuffer(symbol, np.uint8).astype(np.int64), right)
    assert int(state[2][0]) == raw.count(b"dana") == 1  # grown to both sides
    assert index.order[int(state[0][0])] == raw.index(b"dana")


@pytest.mark.parametrize("block", [64, 1 << 15])
def test_spelling_variants_are_those_of_brute_force(spark, block):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = spelling.variants(docs, block_words=block).collect()
    assert {r.word: tuple(r)[1:2] + tuple(r)[2:] for r in found} == variants_by_hand([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def test_spelling_of_odd_tables(spark, odd):
    found = spelling.variants(odd)
    rows = {r.word: tuple(r)[1:] for r in found.collect()}
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"] and len(rows) == found.count()
    assert rows == variants_by_hand([(r.doc_id, r.text) for r in odd.collect()]) and rows["lettre"][3] == rows["letter"][3] == 1
    assert spelling.variants(odd.limit(0)).count() == 0
    hot = spark.createDataFrame([(i, f"prefix{i:04d}".translate(str.maketrans("0123456789", "abcdefghij"))) for i in range(3000) for _ in range(3)], "doc_id long, text string")
    near = spelling.near_words(spelling.vocabulary(hot), block_words=128)  # a half that more words share than a block holds
    words = [r.word for r in spelling.vocabulary(hot).collect()]
    assert near.count() == near.select("word", "near").distinct().count()
    sample = {w: {x for x in words if one_apart(x, w)} for w in words[::97]}
    got = defaultdict(set)
    for r in near.collect():
        got[r.word].add(r.near)
    assert all(got[w] == near_ for w, near_ in sample.items())
    parts, whole = Counter(), "größe ab12 Wörter\n" * 100
    parts.update(spelling.words_of(whole.encode(), b"1:"))
    assert set(parts) <= {"größe".encode(), "wörter".encode()} | {w.encode() for w in ("grße", "größ", "wörtr", "wrter", "wörer", "wöter")}


def test_forms_are_followed_to_the_last(spark):
    links = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(37)], "word string, form string")
    assert {r.root for r in spelling.last_forms(links).collect()} == {"w37"} and spelling.last_forms(links.limit(0)).count() == 0


# --- whitening ---


def eigen(x):
    c = x - x.mean(0)
    e, v = np.linalg.eigh(c.T @ c / len(x))
    return c, e[::-1], v[:, ::-1]


@pytest.mark.parametrize("shape, guard", [((300, 6), 24), ((2000, 40), 4), ((500, 12), 2)])
def test_whitening_is_that_of_a_dense_eigensolver(spark, shape, guard):
    rng = np.random.default_rng(8)
    raw = (rng.normal(0, 1, shape) * np.linspace(0.2, 2, shape[1])).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(raw)], "vec_id long, embedding array<float>").repartition(5)
    x = whitening.usable(df)
    model = whitening.fit(x, guard=guard)
    whole = np.floor(1024 * raw.astype(float)).astype(np.int64) + 100_000
    c, e, v = eigen(whole.astype(float))
    k = min(8, shape[1])
    assert np.allclose(model.values, e[:k], rtol=1e-12) and model.residual < 1e-12 * e[0] and model.n == shape[0] and (model.sums == whole.sum(0)).all()
    out = whitening.whiten(x, model).toPandas()
    table = out.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    want = c @ v[:, :k] / np.sqrt(e[:k])
    assert np.abs(table * np.sign((table * want).sum(0)) - want).max() < 1e-9 and whitening.identity_error(x, model) < 1e-10
    assert [int(d) for d in out.drop_duplicates("vec_id").sort_values("vec_id").deviation] == ((shape[0] * whole - whole.sum(0)) ** 2).sum(1).tolist()
    assert np.allclose(out.groupby("component").explained.first(), e[:k] / e.sum(), rtol=1e-10)


def test_whitening_of_many_equal_vectors_takes_few_passes(spark):
    """A dominating direction above a flat spectrum, which drowned the others in the filter: no end after 60 rounds."""
    rng = np.random.default_rng(8)
    raw = rng.normal(0, 1, (3000, 64))
    raw[::8] = 4 * rng.normal(0, 1, 64)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(raw)], "vec_id long, embedding array<double>").repartition(3)
    model = whitening.fit(whitening.usable(df))
    _, e, _ = eigen((np.floor(1024 * raw) + 100_000))
    assert model.passes <= 45 and np.allclose(model.values, e[:8], rtol=1e-12) and model.residual <= whitening.TOLERANCE * e[0]


def test_whitening_of_odd_tables(spark):
    nan, inf = float("nan"), float("inf")
    good = [[float(i % 7), 0.5 * (i % 5), 3.0] for i in range(40)]
    rows = [*enumerate(good), (None, good[0]), (1, good[1]), (90, None), (91, [1.0, None, 2.0]), (92, [nan, 1.0, 1.0]), (93, [inf, 1.0, 1.0]), (94, [1e30, 0.0, 0.0]), (95, []), (96, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v, "e", 1) for i, v in rows], "vec_id long, embedding array<double>, x string, component int")
    x = whitening.usable(df)
    assert x.count() == 42  # the rest is null, not finite, too large or of another length
    model = whitening.fit(x)
    assert len(model.values) == 2  # the third entry is constant
    out = whitening.whiten(x, model)
    assert out.count() == 84 and out.where("vec_id IS NULL").count() == 2
    c, e, _ = eigen(np.floor(1024 * np.array([*good, good[0], good[1]])) + 100_000)
    assert np.allclose(model.values, e[:2]) and np.isclose(model.trace, e.sum())
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)], "vec_id long, embedding array<float>")
    for none in (same, df.limit(0), df.where("vec_id IN (90, 91, 92)")):
        x = whitening.usable(none)
        assert whitening.whiten(x, whitening.fit(x)).count() == 0
    big = spark.createDataFrame([(i, [float(1 << 30) * (i % 2), float(i)]) for i in range(9)], "vec_id long, embedding array<double>")
    x = whitening.usable(big)
    far = whitening.whiten(x, whitening.fit(x)).where("component = 1").orderBy("vec_id").collect()
    own = [[1024 * (1 << 30) * (i % 2) + 100_000, 1024 * i + 100_000] for i in range(9)]
    sums = [sum(r[k] for r in own) for k in range(2)]
    assert [int(r.deviation) for r in far] == [sum((9 * r[k] - sums[k]) ** 2 for k in range(2)) for r in own]  # beyond 64 bits


# --- parity join ---


def shingle_sets(rows):
    out = {}
    for i, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        out[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    return out


def classes_by_hand(sets, similarity):
    first = {i: i for i in sets}

    def find(i):
        while first[i] != i:
            i = first[i]
        return i

    rare = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            rare[x].append(i)
    for a, b in {(a, b) for ids in rare.values() for a in ids for b in ids if a < b}:
        both = len(sets[a] & sets[b])
        if 100 * both >= similarity * (len(sets[a]) + len(sets[b]) - both):
            one, two = find(a), find(b)
            first[max(one, two)] = min(one, two)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def family(rng, n, base, edits):
    """Texts that differ from one of ``base`` words by some replaced words."""
    words = [f"b{rng.randrange(10**6)}" for _ in range(base)]
    for _ in range(n):
        own = list(words)
        for _ in range(rng.randint(0, edits)):
            own[rng.randrange(base)] = f"e{rng.randrange(10**6)}"
        yield " ".join(own)


@pytest.mark.parametrize("similarity", [60, 80, 95])
def test_join_is_that_of_brute_force(spark, monkeypatch, similarity):
    """Families of short and long texts around the limit, with few comparisons left to stars and with small cells."""
    rng = random.Random(similarity)
    texts = [t for n, base, edits in ((40, 9, 2), (40, 30, 3), (40, 70, 6), (30, 300, 14), (12, 1500, 60), (40, 6, 1)) for t in family(rng, n, base, edits)]
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 9))) for _ in range(120)] + ["a b", "a b c d", "a b c d e"] * 3
    passage = " ".join(f"p{i}" for i in range(60))
    texts += [passage + " " + " ".join(f"q{rng.randrange(10**6)}" for _ in range(rng.randint(3, 60))) for _ in range(60)]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    want = classes_by_hand(shingle_sets(rows), similarity)
    assert len({c for _, c in want.values()}) < len(rows) - 50  # there is something to find
    for few, cell in ((1 << 31, 2048), (1, 8)):
        monkeypatch.setattr(parity_join, "FEW_PAIRS", few)
        monkeypatch.setattr(parity_join, "CELL_SETS", cell)
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in parity_join.similarity_classes(df, similarity).collect()} == want


def test_words_keep_what_similar_sets_share():
    """Sets that differ by at most D shingles agree in a word that both may keep, whatever order words are dropped in."""
    rng = np.random.default_rng(2)
    for size in (4, 5, 7, 8, 15, 16, 40, 63, 64, 100, 300, 1000):
        for _ in range(20):
            drop = int(rng.integers(0, size // 4 + 1))
            a = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
            b = np.unique(np.concatenate([a[rng.permutation(size)[: size - drop // 2]], rng.integers(0, 1 << 63, drop - drop // 2, dtype=np.uint64)]))
            both = len(np.intersect1d(a, b))
            if 100 * both < 80 * (len(a) + len(b) - both):
                continue
            key, sent, row, band, spare = parity_join.words(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), 80)
            begin = np.cumsum(sent) - sent
            jobs = {(r, k): (set(key[s : s + n].tolist()), p) for r, k, s, n, p in zip(row.tolist(), band.tolist(), begin.tolist(), sent.tolist(), spare.tolist(), strict=True)}
            salt = int(rng.integers(1, 1 << 31))
            kept = {j: sorted(ks, key=lambda x: (x * salt) % ((1 << 61) - 1))[p:] for j, (ks, p) in jobs.items()}
            assert any(set(kept[0, k]) & set(kept.get((1, k), [])) for r, k in kept if r == 0)


def test_sketches_bound_the_difference():
    rng = np.random.default_rng(7)
    for n in (5, 60, 700):
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[: n // 2], rng.integers(0, 1 << 63, n, dtype=np.uint64)]))
        one, two = parity_join.bit_sketch(a).view(np.uint64), parity_join.bit_sketch(b).view(np.uint64)
        width = min(len(one), len(two))
        distance = int(np.bitwise_count(parity_join.folded(one, width) ^ parity_join.folded(two, width)).sum())
        assert 0 < distance <= len(np.setxor1d(a, b)) and distance % 2 == len(np.setxor1d(a, b)) % 2


def test_cells_lose_no_pair():
    """Sets of a cell, in one part and in two, against all pairs whose sketches allow similarity."""
    rng = np.random.default_rng(11)
    base = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    sets = [np.unique(np.concatenate([base[rng.permutation(60)[: 60 - k % 9]], rng.integers(0, 1 << 63, k % 9, dtype=np.uint64)])) for k in range(40)]
    similar = {(a, b) for a in range(40) for b in range(a + 1, 40) if 100 * len(np.intersect1d(sets[a], sets[b])) >= 80 * len(np.union1d(sets[a], sets[b]))}
    assert 50 < len(similar) < 700
    for side in ([0] * 40, [k % 2 for k in range(40)]):
        rows = {"key": [7] * 40, "node": list(range(40)), "label": list(range(40)), "i": [0] * 40, "j": [max(side)] * 40, "side": side, "n": [len(s) for s in sets], "sketch": [parity_join.bit_sketch(s).tolist() for s in sets]}
        pairs = parity_join.pairs_of(pa.RecordBatch.from_pydict(rows), 80).to_pylist()
        found = {(r["a"], r["b"]) for r in pairs}
        assert len(found) == len(pairs) and found >= {(a, b) for a, b in similar if max(side) == 0 or side[a] != side[b]}


def test_join_of_odd_tables(spark, odd, monkeypatch):
    found = parity_join.similarity_classes(odd).collect()
    by = defaultdict(list)
    for r in found:
        by[r.doc_id].append((r.n_shingles, r.component_id))
    assert len(found) == 15 and by[0] == [(0, 0)] and by[2] == [(0, 2)] and by[6] == by[8] == [(36, 5)] and by[7] == [(37, 5)] and by[None] == [(37, 5)] and by[12] == [(1, 4)]
    assert sorted(by[5]) == [(2, 5), (36, 5)] and parity_join.similarity_classes(odd.limit(0)).count() == 0
    real = parity_join.fingerprints

    def clashing(value, at, seed):
        out = real(value, at, seed)
        if seed == 0:  # names clash at first
            out[0] %= 3
        return out

    monkeypatch.setattr(parity_join, "fingerprints", clashing)
    assert parity_join.named(odd, "doc_id", "text", 80, 0).where("node IS NOT NULL").select("node").distinct().count() <= 3
    assert sorted(map(str, parity_join.similarity_classes(odd).collect())) == sorted(map(str, found))
    with pytest.raises(ValueError):
        parity_join.similarity_classes(odd, 50)


def test_frequent_words_are_dealt(spark, monkeypatch):
    """Words that a sample shows to be frequent go to several tasks, and the classes stay what they are."""
    rng = random.Random(1)
    rows = list(enumerate(family(rng, 300, 60, 3)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for name, value in (("SAMPLE", 2), ("OFTEN", 4), ("SLICE", 16)):
        monkeypatch.setattr(parity_join, name, value)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in parity_join.similarity_classes(df).collect()} == classes_by_hand(shingle_sets(rows), 80)


# --- calibration of toxicity ---


def test_equal_votes_have_one_rate_and_scores_are_rates(spark):
    """Held-out documents of sf0.1: in every range of scores the share of toxic ones is what the scores say."""
    from tableforge.llm import toxicity

    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet").where("toxic IS NOT NULL").select("doc_id", "toxic")
    rows = toxicity.op9_toxicity(spark, sf).where("held_out").join(labels, "doc_id").select("score", "predicted", "toxic").toPandas()
    assert len(rows) > 800 and abs(rows.score.mean() - rows.toxic.mean()) < 0.02
    for low, high in ((0, 0.05), (0.05, 0.2), (0.2, 0.5), (0.5, 0.8), (0.8, 1.01)):
        own = rows[(rows.score >= low) & (rows.score < high)]
        assert len(own) < 20 or abs(own.score.mean() - own.toxic.mean()) < 0.05
    hit = int((rows.predicted * rows.toxic).sum())
    assert hit >= 0.95 * rows.predicted.sum() and hit >= 0.94 * rows.toxic.sum()
