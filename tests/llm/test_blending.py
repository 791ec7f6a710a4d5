"""Mixing, fill-in-middle and clustering: each against brute force and its SQL, and the odd cases of each."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from cases import pairs_of
from quadrangle.llm import centroids, infill, mixing, queries

NEW = ["op11_mixing", "op12_fill_in_middle", "op13_centroids"]


@pytest.mark.parametrize("name", NEW)
def test_same_as_sql(name, same_as_sql):
    same_as_sql(queries.queries()[name], queries.oracle_sql()[name])


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---------------------------------------------------------------- 11


def fair_targets(sizes):
    """Targets by repeated sharing, as the contract tells it."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    left, open_, out = Fraction(3 * sum(sizes.values()), 2), set(order), {}
    while open_:
        share = left / sum(weight[s] for s in open_)
        above = [s for s in open_ if share * weight[s] > 2 * sizes[s]]
        if not above:
            out |= {s: share * weight[s] for s in open_}
            break
        for s in above:
            out[s] = Fraction(2 * sizes[s])
            left -= out[s]
            open_.remove(s)
    return out


@pytest.mark.parametrize(("seed", "block_words", "shard_blocks", "bucket"), [(1, 512, 1024, 2048), (2, 16, 8, 5), (3, 7, 2, 3)])
def test_mix(documents, monkeypatch, seed, block_words, shard_blocks, bucket):
    monkeypatch.setattr(mixing, "BUCKET", bucket)
    monkeypatch.setattr(mixing, "LEVELS", 4)
    docs = documents(seed)
    mix = mixing.Mix(docs, block_words=block_words, shard_blocks=shard_blocks)
    words, rows = defaultdict(int), docs.collect()
    for r in rows:
        words[r.source] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
    wanted = fair_targets(words)
    known = {r.source: (r.source_size, r.target) for r in mix.sources.collect()}
    assert {s: n for s, (n, _) in known.items()} == words
    assert all(abs(t - wanted[s]) < 1e-6 for s, (_, t) in known.items())
    out = mix.taken().collect()
    assert Counter((r.doc_id, r.size) for r in out) == Counter((r.doc_id, len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))) for r in rows)
    assert all(0 <= r.taken <= 2 * r.size for r in out)
    assert sum(r.taken for r in out) == sum(math.floor(t + Fraction(1, 2)) for t in wanted.values())
    # the mix itself: every source has its target to the word, no word of a pass comes twice, shards are equal
    pieces = mix.pieces.join(mix.sources.select("s", "source", "target"), "s").collect()
    per_source, times, blocks = Counter(), Counter(), defaultdict(set)
    for p in pieces:
        per_source[p.source] += p.n_words
        blocks[p.shard].add((p.s, p.slot))
        times.update((p.doc_id, p.h, p.copy, w) for w in range(p.from_word, p.from_word + p.n_words))
    assert per_source == Counter({s: math.floor(t + Fraction(1, 2)) for s, t in wanted.items() if t})
    assert max(times.values()) <= 2
    assert all(len({times[d, h, c, w] for w in range(10) if (d, h, c, w) in times}) <= 2 for d, h, c, _ in list(times)[:200])
    sizes = [len(b) for b in blocks.values()]
    assert len(sizes) == mix.n_shards and max(sizes) - min(sizes) <= 1
    assert len({b for some in blocks.values() for b in some}) == sum(sizes)
    # texts: a word of a piece is the document's word
    text = mix.rows().collect()
    assert sum(len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in text) == sum(r.n_words for r in text) == sum(per_source.values())
    assert len({(r.shard, r.place) for r in text}) == len(text) == len(pieces)
    again = mixing.Mix(docs.repartition(7), block_words=block_words, shard_blocks=shard_blocks)
    assert sorted(map(str, again.rows().collect())) == sorted(map(str, text))


def test_mix_odd_cases(spark, no_documents, documents):
    assert mixing.Mix(no_documents).taken().count() == 0 and mixing.Mix(no_documents).rows().count() == 0
    empty = documents(1).where("text is null or trim(text) = ''")
    out = mixing.Mix(empty).taken().collect()
    assert len(out) == empty.count() and {(r.size, r.source_size, r.target, r.taken) for r in out} == {(0, 0, 0.0, 0)}
    # a hot source, rows alike, null ids and one very long text
    rows = [(i, "one two three", "hot") for i in range(40)] + [(None, "a b c d", None)] * 25 + [(7, "w " * 30_000, "long"), (7, "x y", "long"), (8, None, "none")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.Mix(docs, block_words=64, shard_blocks=16).taken().collect()
    assert len(got) == len(rows) and all(r.taken <= 2 * r.size for r in got)
    by = defaultdict(int)
    for r in got:
        by[r.source_size, r.target] += r.taken
    assert all(abs(taken - target) <= 1 for (_, target), taken in by.items())


def test_shuffle_is_a_bijection(spark):
    for n in (1, 2, 3, 10, 97, 1000):
        rows = spark.range(n).select(*(mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(s), 5).alias(f"p{s}") for s in (0, 1))).collect()
        assert all(sorted(r[i] for r in rows) == list(range(n)) for i in (0, 1))
        if n == 1000:
            assert sum(r.p0 == r.p1 for r in rows) < 20
            assert sum(b.p0 == a.p0 + 1 for a, b in zip(rows, rows[1:], strict=False)) < 20


@pytest.mark.parametrize(
    ("total", "good", "taken", "wide"),
    [(20, 7, 9, 20), (1000, 300, 10, 20), (50, 50, 20, 20), (50, 1, 25, 20), (1000, 300, 200, 2), (60, 20, 30, 1), (400, 390, 200, 1), (10**10, 3 * 10**8, 5 * 10**9, 20)],
)
def test_hypergeometric(spark, monkeypatch, total, good, taken, wide):
    monkeypatch.setattr(mixing, "WIDE", wide)
    n = 20_000
    got = [r.x for r in spark.range(0, n, 1, 4).select(mixing.hypergeometric(*(F.lit(v) for v in (total, good, taken)), F.xxhash64("id")).alias("x")).collect()]
    assert max(0, taken - total + good) <= min(got) and max(got) <= min(taken, good)
    mean, share = taken * good / total, good / total
    spread = math.sqrt(taken * share * (1 - share) * (total - taken) / (total - 1))
    assert abs(sum(got) / n - mean) <= 4 * spread / math.sqrt(n) + 1e-9
    assert spread == 0 or abs(sum((x - mean) ** 2 for x in got) / n / spread**2 - 1) < 0.05
    if total <= 1000:  # against the exact distribution: no count is off by more than five deviations
        seen = Counter(got)
        for x in range(max(0, taken - total + good), min(taken, good) + 1):
            p = math.comb(good, x) * math.comb(total - good, taken - x) / math.comb(total, taken)
            assert abs(seen[x] - n * p) <= 5 * math.sqrt(n * p * (1 - p)) + 1


# ---------------------------------------------------------------- 12


def infilled(doc_id, text, seed=7, percent=100, spm=50):
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest, n = sha(f"{seed}:{'' if doc_id is None else doc_id}"), len(units)
    h = [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= percent:
        return n, "plain", None, None, text
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < spm:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


ODD = ["a\nb", "\n", "\n\n\n", "a\r\nb\r", " x\x85y\n", "\U0001f600\n\U0001f600é", "<P>x\ny", "x<S>", "<M>\n", "< P>\n<p>\n", "\x00\n\x00", "l" * 1_000_000 + "\nend", "x\n" * 100_000]


@pytest.mark.parametrize(("seed", "percent", "spm"), [(7, 100, 50), (3, 60, 0), (4, 0, 100)])
def test_infilling_like_brute_force(spark, documents, seed, percent, spm):
    docs = documents(seed)
    more = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(ODD)], "doc_id long, text string")
    docs = docs.unionByName(more, allowMissingColumns=True)
    out = infill.transform(docs, seed, percent, spm)
    out = out.withColumn("restored", infill.restored(F.col("output"), F.col("form"))).collect()
    wanted = [(d, *infilled(d, t, seed, percent, spm), t) for d, t in pairs_of(docs)]
    assert sorted(map(repr, (tuple(r) for r in out))) == sorted(map(repr, wanted))
    assert percent in (0,) or {"psm" if spm == 0 else "spm", "plain"} <= {r.form for r in out}


def test_infilling_of_nothing(no_documents):
    assert infill.transform(no_documents).collect() == []


# ---------------------------------------------------------------- 13


def lloyd(rows, k=16, rounds=3):
    fine = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    centres = [v for _, v in sorted(fine, key=lambda r: (sha(f"1:{'' if r[0] is None else r[0]}"), r[1]))[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centres))

    for _ in range(rounds):
        groups = defaultdict(list)
        for _, v in fine:
            groups[nearest(v)[1]].append(v)
        for j, vs in groups.items():
            centres[j] = [sum(col) // len(vs) for col in zip(*vs, strict=True)]
    found = [(i, *nearest(v)[::-1]) for i, v in fine]
    inertia = Counter()
    for _, j, d in found:
        inertia[j] += d
    return [(i, j, d, inertia[j], sum(inertia.values()), sha(",".join(map(str, centres[j])))) for i, j, d in found]


@pytest.mark.parametrize("n", [3, 16, 150])
def test_clusters_like_brute_force(spark, n):
    rnd = random.Random(n)
    rows = [(10**15 + i, [rnd.choice((0.25, -1, 3, 1000)) * rnd.random() for _ in range(64)], "x", 0) for i in range(n)]
    rows += [rows[0], rows[1], (rows[2][0], rows[1][1], None, None), (None, rows[0][1], "x", 1), (None, [0.0] * 64, "x", 1)]
    rows += [(5, None, "x", 1), (6, [1.0] * 63, "x", 1), (7, [], "x", 1), (8, [None, *[1.0] * 63], "x", 1), (9, [math.nan, *[1.0] * 63], "x", 1), (4, [-math.inf, *[1.0] * 63], "x", 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, cluster string, v int").repartition(5)
    assert sorted(map(repr, map(tuple, centroids.cluster(frame).collect()))) == sorted(map(repr, lloyd([r[:2] for r in rows])))


def test_clusters_of_nothing_and_of_large_numbers(spark):
    shape = "vec_id long, embedding array<double>"
    assert centroids.cluster(spark.createDataFrame([], shape)).count() == 0
    assert centroids.cluster(spark.createDataFrame([(1, None), (2, [1.0])], shape)).count() == 0
    out = centroids.cluster(spark.createDataFrame([(i, [s * 1e300] * 64) for i, s in enumerate((1, -1, 1, -1))] + [(9, [0.0] * 64)], shape), k=1).collect()
    assert len(out) == 5 and all(0 <= r.distance < 1 << 63 for r in out)
