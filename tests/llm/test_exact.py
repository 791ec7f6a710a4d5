"""Operators whose results are exact, against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cases import pairs_of, prose
from quadrangle.llm import bpe, common, linedup, minhash, packing, quality, queries, rounds, stages, suffixdedup, tokenfiles, topk
from quadrangle.llm.units import tokenizer


def same_rows(frame, expected):
    got = sorted(map(str, (tuple(r) for r in frame.collect())))
    assert got == sorted(map(str, expected))


# ---------------------------------------------------------------- 1


def without_repeats(rows, width):
    windows = Counter(t[i : i + width] for _, s in rows for t in [s.encode()] for i in range(len(t) - width + 1))
    for doc_id, s in rows:
        t = s.encode()
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - width + 1):
            if windows[t[i : i + width]] > 1:
                gone[i : i + width] = True
        kept = bytes(b for b, g in zip(t, gone, strict=False) if not g)
        runs = int((np.diff(gone.astype(int)) == 1).sum() + gone[0])
        yield doc_id, len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize(("seed", "hot"), [(1, 2000), (2, 2), (3, 1)])
def test_repeats_like_brute_force(documents, seed, hot):
    docs = documents(seed)
    same_rows(suffixdedup.remove_repeats(docs, hot=hot), without_repeats(pairs_of(docs), 200))


def test_repeats_of_nothing(no_documents, spark):
    assert suffixdedup.remove_repeats(no_documents).count() == 0
    assert suffixdedup.cut_repeats(no_documents).columns == no_documents.columns


def test_cut_repeats_keeps_columns(documents):
    docs = documents(1).where("doc_id is not null").dropDuplicates(["doc_id"])
    out = {r.doc_id: r for r in suffixdedup.cut_repeats(docs).collect()}
    for doc_id, t in pairs_of(docs):
        if doc_id in out:
            assert (out[doc_id].n_chars, out[doc_id].key, out[doc_id].text_) == (len(out[doc_id].text or ""), "k", "t")
    assert docs.columns == suffixdedup.cut_repeats(docs).columns


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab", max_size=14), min_size=1, max_size=8), st.integers(1, 3))
def test_merged_transforms(strings, shards):
    width, steps = 4, 2
    found = suffixdedup.repeated_windows([s.encode() for s in strings], np.ones(len(strings), np.int64), width, steps, shards)
    count = Counter(s[i : i + width] for s in strings for i in range(len(s) - width + 1))
    assert [w.tolist() for w in found] == [[i for i in range(len(s) - width + 1) if count[s[i : i + width]] > 1] for s in strings]


# ---------------------------------------------------------------- 2


def test_quality_like_sql(same_as_sql):
    same_as_sql(queries.op2_quality_rules, queries.OP2_SQL)


def counts(text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen = Counter(windows)
    covered = {j for i, w in enumerate(windows) if seen[w] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed


def test_quality_counts(documents, spark):
    docs = documents(4)
    more = ["a b c d e f g h i j a b c d e", "one two three four five one two three four five six", "x\x0by\x0cz", "# * | " * 20, "line here\nline here\nline here\n" * 3, " wide space"]
    docs = docs.unionByName(spark.createDataFrame([(1000 + i, t) for i, t in enumerate(more)], "doc_id long, text string"), allowMissingColumns=True)
    out = quality.assess(docs).drop("kept")
    same_rows(out, [(d, *counts(t)) for d, t in pairs_of(docs)])


def test_quality_line_ends_and_long_runs(spark, duck):
    """Only \\n ends a line; a long run without letters takes no longer than other text."""
    words = "one two three four five six seven eight nine ten eleven twelve"
    texts = [f"{words}...\r\n" * 1 + words[::-1], f"* a\u2028* b\n{words}", f"{words}\u0085- x\r- y", "\n".join(f"• {w}{i} and more of it" for i, w in enumerate(words.split())), f"{words} " + "7" * 1_000_000, f"{words}...", None]
    rows = list(enumerate(texts))
    got = quality.assess(spark.createDataFrame(rows, "doc_id long, text string"), ["letters", "ellipses", "bullets", "symbols", "word_length", "repeated_lines"])
    import pandas as pd

    con = duck.cursor()
    con.register("given", pd.DataFrame(rows, columns=["doc_id", "text"]))
    expected = con.sql(queries.OP2_SQL.replace("FROM documents", "FROM given"))
    same_rows(got.select("doc_id", "n_words", "n_dup_lines", "base_failed", "kept"), expected.project("doc_id, n_words, n_dup_lines, base_failed, kept").fetchall())


def test_quality_order_changes_nothing(documents):
    docs = documents(5)
    order = [name for name, _, _ in quality.ordered(docs)]
    assert sorted(order) == ["bullets", "ellipses", "letters", "repeated_lines", "symbols", "word_length"]
    same_rows(quality.assess(docs, order), [tuple(r) for r in quality.assess(docs, order[::-1]).collect()])
    assert quality.keep(docs, order).count() == quality.assess(docs, order).where("kept").count()
    assert quality.keep(docs, order).columns == docs.columns


def test_quality_of_nothing(no_documents):
    assert quality.assess(no_documents).count() == 0


# ---------------------------------------------------------------- 3


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        left, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            left, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, left + (x != y))
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(st.text("abé", max_size=12), st.text("abé", max_size=12), st.integers(0, 4))
def test_banded_distance(a, b, k):
    assert linedup.edit_distance(a, b, k) == min(distance(a, b), k + 1)


def line_rows(rows):
    """Every line with the first line of its class and whether it is that, by comparing all lines."""
    place = lambda p: (p[0] is not None, p)  # noqa: E731  nulls first
    lines = [(d, i, x) for d, t in rows for i, x in enumerate(t.split("\n")) if re.search("[^\x20\x09-\x0d]", x)]
    first = {}
    for d, i, x in sorted(lines, key=lambda p: place(p[:2])):
        first.setdefault(x, (d, i))
    token = {x: linedup.tokens(x) for x in first}

    def near(x, y):
        k = linedup.limit(max(len(token[x]), len(token[y])))
        few = max(len(token[x]), len(token[y])) < linedup.FEW
        return abs(len(token[x]) - len(token[y])) <= k and distance(token[x], token[y]) <= k and not (few and distance(x, y) > 2)

    root = {}
    for x in sorted(first, key=lambda x: place(first[x])):
        todo = [x] if x not in root else []
        while todo:
            y = todo.pop()
            if y not in root:
                root[y] = first[x]
                todo += [z for z in first if z not in root and near(y, z)]
    return [(d, i, len(x), *root[x], root[x] == (d, i)) for d, i, x in lines]


def changed(rnd, words, k):
    """words with k of them replaced, left out or added."""
    words = list(words)
    for _ in range(k):
        at, how = rnd.randrange(len(words)), rnd.random()
        if how < 0.5:
            words[at] = f"z{rnd.randrange(99)}"
        elif how < 0.75 and len(words) > 1:
            del words[at]
        else:
            words.insert(at, f"y{rnd.randrange(99)}")
    return words


@pytest.mark.parametrize("crowded", [4096, 20])
def test_lines_like_brute_force(spark, crowded, monkeypatch):
    """Lines on both sides of every limit, lines that only share a part, and rows that share a doc_id or have none."""
    monkeypatch.setattr(rounds, "CROWDED", crowded)
    rnd = random.Random(6)
    words = [f"w{i}" for i in range(400)] + ["été", "über"]
    some = lambda n: [rnd.choice(words) for _ in range(n)]
    lines = []
    for n in (1, 2, 3, 4, 5, 7, 8, 15, 16, 17, 30, 47, 48, 50, 64, 80, 150):
        base = some(n)
        lines += [" ".join(base), *(" ".join(changed(rnd, base, k)) for k in range(linedup.limit(n) + 3))]
    common = some(20)
    for n in (10, 22, 40):
        tails = [some(n) for _ in range(25)]
        lines += [" ".join(common + t) for t in tails] + [" ".join(common + changed(rnd, t, 2)) for t in tails[:6]]
    lines += ["日本語のテキストです、これは長い行であります", "日本語のテキストでした、これは長い行であります", "short", "short"]
    rnd.shuffle(lines)
    rows = [(i // 3, "\n".join(lines[i : i + 3])) for i in range(0, len(lines), 3)]
    rows += [(None, "short\n \n" + lines[4]), (2, lines[5] + "\nx"), (None, "more\n" + lines[6]), (700, None), (701, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = linedup.line_classes(docs).select("doc_id", "line_no", "n_chars", "class_doc_id", "class_line_no", "kept").collect()
    expected = line_rows([(d, t or "") for d, t in rows])
    assert sorted(str(tuple(r)[:5]) for r in got) == sorted(str(r[:5]) for r in expected)
    # of every class a line is kept; where rows share a doc_id, classes can have places of one name
    assert {tuple(r)[3:5] for r in got if r.kept} == {r[3:5] for r in expected}


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=12), st.lists(st.integers(0, 2), max_size=12), st.integers(0, 5))
def test_edits_along_diagonals(a, b, k):
    assert linedup.within(np.array(a, np.int64), np.array(b, np.int64), k) == (distance(a, b) <= k)


def test_near_copies_are_not_written_as_pairs(spark):
    """A group of near copies meets in one task, and of lines that only share a key no pair is made."""
    rnd = random.Random(9)
    base = [f"w{i}" for i in range(40)]
    lines = [" ".join([*base[:i], f"z{rnd.random()}", *base[i + 1 :]]) for i in (rnd.randrange(20, 40) for _ in range(300))]
    lines += [" ".join([*"abcd", *(f"{x}{i}" for x in "vwxyz")]) for i in range(600)]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    keys = linedup.key_table(docs)
    found = linedup.candidates(keys, 500).collect()
    assert sum(r.key is not None and not r.crowded for r in found) >= 300  # passed on as lines
    assert sum(r.crowded for r in found) >= 600
    crowded = linedup.candidates(keys, 500).where("crowded").select("key", F.col("a").alias("id"), "about")
    texts = linedup.line_texts(docs, linedup.line_table(docs).withColumnRenamed("h", "id"))
    assert linedup.candidates(linedup.finer_keys(crowded, texts), None).count() < 600  # of 180,000
    got = linedup.line_classes(docs).groupBy("class_doc_id").count().collect()
    assert sorted(r["count"] for r in got)[-2:] == [1, 300] and len(got) == 601


def test_pairs_are_verified_at_once():
    """Bands of every width, bands too wide for a number, and few or many pairs agree with the distance of one pair."""
    rnd = random.Random(12)
    lines = [changed(rnd, base, rnd.randrange(2 * linedup.limit(n) + 2)) for n in (4, 15, 16, 48, 111, 128, 255, 256, 500, 530) for base in [[f"w{rnd.randrange(40)}" for _ in range(n)]] for _ in range(9)]
    text = pa.array([" ".join(x) for x in lines])
    values, n = linedup._tokens_of(text)
    pairs = np.array([(i, j) for i in range(len(lines)) for j in range(i) if abs(len(lines[i]) - len(lines[j])) < 40])
    most = [linedup.limit(max(len(lines[i]), len(lines[j]))) for i, j in pairs]
    expected = [linedup.edit_distance(lines[i], lines[j], k) <= k for (i, j), k in zip(pairs, most, strict=True)]
    got = linedup.few_edits(values, np.cumsum(n) - n, n, pairs[:, 0], pairs[:, 1])
    assert got.tolist() == expected and 40 < sum(expected) < len(expected) - 40
    some = slice(len(pairs) - 5, None)
    assert linedup.few_edits(values, np.cumsum(n) - n, n, *pairs[some].T).tolist() == expected[some]
    odd = linedup.parities(linedup.numbered(values, n), n, linedup.BITS)
    assert all((odd[i] != odd[j]).sum() <= 2 * k for (i, j), k, ok in zip(pairs, most, expected, strict=True) if ok)


def test_lines_of_repeated_words_are_no_candidates(spark):
    """Lines that repeat different words an even number of times have no odd bits; they are told apart before their texts meet."""
    words = [["b"] * 48 + ["c"] * 48, ["d"] * 48 + ["e"] * 48, ["b"] * 47 + ["c"] * 48 + ["f"]]
    docs = spark.createDataFrame([(i, " ".join(w * 6)) for i, w in enumerate(words)], "doc_id long, text string")
    texts = linedup.line_texts(docs, linedup.line_table(docs).withColumnRenamed("h", "id"))
    ids = [r.h for r in linedup.line_table(docs).orderBy("doc_id").collect()]
    pairs = spark.createDataFrame([(ids[0], ids[1]), (ids[0], ids[2])], "a long, b long")
    assert [tuple(r) for r in linedup.likely(pairs, texts).collect()] == [(ids[0], ids[2])]
    assert [tuple(r) for r in linedup.verified(pairs, texts).collect()] == [(ids[0], ids[2])]
    assert sorted((r.doc_id, r.class_doc_id) for r in linedup.line_classes(docs).collect()) == [(0, 0), (1, 1), (2, 0)]


def test_very_long_lines_are_told_apart(spark):
    """Beyond 8,192 tokens the limit allows more odd bits than a line has; pairs of tokens tell such lines apart before their texts meet."""
    rnd = random.Random(14)
    words = [f"w{i}" for i in range(60)]
    lines = [[*"abcde", *rnd.choices(words, k=8300 + i)] for i in range(6)]
    lines.append(changed(rnd, lines[2], 400))
    docs = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(lines)], "doc_id long, text string")
    texts = linedup.line_texts(docs, linedup.line_table(docs).withColumnRenamed("h", "id"))
    ids = [r.h for r in linedup.line_table(docs).orderBy("doc_id").collect()]
    pairs = spark.createDataFrame([(ids[i], ids[j]) for i in range(7) for j in range(i)], "a long, b long")
    assert [tuple(r) for r in linedup.likely(pairs, texts).collect()] == [(ids[6], ids[2])]
    assert linedup.forest(pa.array([" ".join(x) for x in lines]), np.zeros(7, int)) in ([(2, 6)], [(6, 2)])
    for n in (63, 64, 65, 129, 2050):  # bits of lines on both sides of a power of two meet as the fewer ones
        base = rnd.choices(words, k=n)
        for k in (0, 1, 4, 7):
            x, y = (linedup.pair_parities(linedup._tokens_of(pa.array([" ".join(z)]))[0]) for z in (base, changed(rnd, base, k)))
            assert linedup.pairs_alike(x, y, k) and linedup.pairs_alike(y, x, k)


def test_near_copies_meet_once(spark):
    """Groups of the same near copies become one, and every two lines that share a key still meet."""
    rnd = random.Random(15)
    base = [f"w{i}" for i in range(150)]
    lines = [" ".join(changed(rnd, base, rnd.randrange(1, 8))) for _ in range(150)]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    found = linedup.candidates(linedup.key_table(docs), 4096)
    before = found.where("key is not null").select("key", F.col("a").alias("id"), "about")
    own = common.Scratch(spark)
    groups = {}
    for frame in (before, linedup.gathered(own, before)):
        for r in frame.collect():
            groups.setdefault(frame is before, {}).setdefault(r.key, set()).add(r.id)
    own.clear()
    assert sum(map(len, groups[True].values())) > 1500  # a text would be sent for each
    assert sum(map(len, groups[False].values())) < 400
    assert all(any(x <= y for y in groups[False].values()) for x in groups[True].values())


def test_crowded_keys_are_divided_by_length(spark, monkeypatch):
    """Lines of many lengths that share a gram need no parts of their texts; divided in any way, lines are linked as by comparing all."""
    rnd = random.Random(16)
    shared = [f"s{i}" for i in range(12)]
    lines = [[*shared, *(f"w{rnd.randrange(3000)}" for _ in range(n))] for n in range(40, 240, 2)]
    lines += [changed(rnd, x, rnd.randrange(1, 12)) for x in lines[::4]]
    rows = [(i, " ".join(x)) for i, x in enumerate(lines)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = sorted(line_rows(rows))
    classes = lambda: sorted(tuple(r)[:6] for r in linedup.line_classes(docs).select("doc_id", "line_no", "n_chars", "class_doc_id", "class_line_no", "kept").collect())
    monkeypatch.setattr(rounds, "CROWDED", 10)
    with monkeypatch.context() as m:
        m.setattr(linedup, "finer_keys", None)
        assert classes() == expected
    monkeypatch.setattr(linedup, "LARGE", 1)
    assert classes() == expected
    keys = spark.createDataFrame([(1, n, n) for n in (*range(1, 400), 4700, 5000, 61439, 65535)], "key long, id long, about long")
    bands = {}
    for r in linedup.banded(keys).collect():
        bands.setdefault(r.id, set()).add(r.band)
    assert all(bands[m] & bands[n] for m in bands for n in bands if n <= m and m - linedup.limit(m) <= n)


def test_short_lines_have_rows(spark, tmp_path):
    """Every line that is not blank has a row in the query; those of fewer than four words are linked by equality alone."""
    long = "A line of more than four and twenty characters"
    rows = [(1, f"Fin.\n{long}\n \t\n\nAll rights reserved."), (2, f"All rights reserved.\n{long}\nFin."), (3, "All rights reserved,\né"), (4, "é")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op3_line_dedup(spark, str(tmp_path)).select("doc_id", "line_no", "n_chars", "class_doc_id", "class_line_no", "kept")
    copies = [(2, 0, 20, 1, 4, False), (2, 1, 46, 1, 1, False), (2, 2, 4, 1, 0, False), (4, 0, 1, 3, 1, False)]
    same_rows(got, [(d, i, n, d, i, True) for d, i, n in [(1, 0, 4), (1, 1, 46), (1, 4, 20), (3, 0, 20), (3, 1, 1)]] + copies)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = [(r.doc_id, r.text) for r in stages.drop_repeated_lines(spark, docs, "").collect()]
    assert sorted(left) == [rows[0], rows[2]]


def test_lines_of_texts_that_share_an_id(spark):
    """A line is looked up in its own text, also where other texts have the same or no doc_id; no text is lost."""
    one, two = "A line of more than four and twenty characters", "Another line that stands in several of the texts"
    rows = [(None, f"short\n{one}"), (None, "short"), (5, f"{two}\nx"), (5, "y"), (6, f"{one} now"), (7, f"{two} here"), (None, f"more\nlines\n{two} too")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = "\n".join(r.text for r in linedup.dedup_lines(docs).collect()).split("\n")
    assert sorted(left) == sorted(["short", one, "x", "y", "more", "lines", f"{two} too"])
    assert linedup.dedup_lines(spark.createDataFrame([(1, f"{one}\nL"), (1, f"L\n{two}"), (0, "L")], "doc_id long, text string")).count() == 3


def test_regular_strings_have_hashes_of_their_own(spark):
    """Strings of a build for which a polynomial modulo a power of two fails."""
    a, b = "a", "b"
    for _ in range(12):
        a, b = a + b, b + a
    docs = spark.createDataFrame([(1, a), (2, b), (3, a)], "doc_id long, text string")
    assert sorted((r.doc_id, r.component_id) for r in minhash.near_duplicates(docs, 2).collect()) == [(1, 1), (2, 2), (3, 1)]
    assert sorted((r.doc_id, r.class_doc_id) for r in linedup.line_classes(docs).collect()) == [(1, 1), (2, 2), (3, 1)]
    for _, _, data, off in common.steps(pa.array([a, b])):
        flat, n = tokenfiles.encode_bytes(tokenfiles.worker_units(tokenfiles.vocabulary(), 1), data, off)
        assert [x.tolist() for x in np.split(flat, np.cumsum(n)[:-1])] == [[*ids_of(t, tokenfiles.vocabulary()), 1] for t in (a, b)]


def test_rows_that_share_an_id(spark):
    """One doc_id with two texts, and several rows without one, in the operators that know rows by a key."""
    rnd = random.Random(8)
    a, b, shared = prose(rnd, 90), prose(rnd, 90), prose(rnd, 60)
    rows = [(1, f"{a} {shared}"), (1, f"{b}"), (2, f"{a} {shared} end"), (3, f"{b} end"), (None, f"{prose(rnd, 40)} {shared}"), (None, prose(rnd, 50)), (1, b), (4, prose(rnd, 30))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    same_rows(suffixdedup.remove_repeats(docs), without_repeats(rows, 200))
    near = {(r.doc_id, r.component_id) for r in minhash.near_duplicates(docs, 5).collect()}
    assert near == {(1, 1), (2, 1), (3, 1), (4, 4), (None, None)}
    left = sorted(r.text for r in minhash.first_of_each(docs).collect())
    assert left == sorted([rows[0][1], rows[1][1], rows[4][1], rows[5][1], rows[7][1]])
    many = spark.createDataFrame([(None, "same", "s")] * 500 + [(1, f"t{i}", "s") for i in range(500)], "doc_id long, text string, source string")
    packed = packing.pack(many, shard_rows=50).groupBy("shard").count().collect()
    assert len(packed) == 20 and max(r["count"] for r in packed) < 100 and sum(r["count"] for r in packed) == 1000


def test_line_dedup_of_nothing(no_documents):
    assert linedup.line_classes(no_documents).count() == 0
    assert linedup.dedup_lines(no_documents).columns == no_documents.columns


# ---------------------------------------------------------------- 5


def best(rows, k=10):
    vectors = [(i, np.floor(1024 * np.array(v, float)).astype(np.int64)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    queries_ = {}
    for i, v in vectors:
        if i % 100 == 0 and (i not in queries_ or v.tolist() < queries_[i].tolist()):
            queries_[i] = v
    for q, v in queries_.items():
        scores = sorted((-int(v @ x), i) for i, x in vectors if i != q)[:k]
        yield from ((q, n + 1, i, -s) for n, (s, i) in enumerate(scores))


@pytest.mark.parametrize(("n", "block"), [(700, 4096), (150, 2), (4, 4096)])
def test_topk_like_brute_force(spark, n, block):
    rnd = random.Random(n)
    rows = [(i, [rnd.choice([rnd.gauss(0, 1), 0.5]) for _ in range(8)]) for i in range(n)]
    rows += [(i, rows[1][1]) for i in (n, n + 1, 200, 200)] + [(n + 2, None), (None, [1.0] * 8), (n + 3, [float("nan")] * 8), (n + 4, [float("inf")] + [0.0] * 7), (n + 5, [None] * 8)]
    frame = spark.createDataFrame([(*r, 0, 1.0) for r in rows], "vec_id long, embedding array<float>, label int, score double")
    same_rows(topk.search(frame, F.col("vec_id") % 100 == 0, query_block=block), best([(r.vec_id, r.embedding) for r in frame.collect()]))


def test_topk_of_nothing(spark):
    assert topk.search(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.col("vec_id") % 100 == 0).count() == 0
    short = spark.createDataFrame([(100, [1.0, 2.0]), (1, [1.0]), (2, [])], "vec_id long, embedding array<float>")
    same_rows(topk.search(short, F.col("vec_id") % 100 == 0), [(100, 1, 1, 1024 * 1024), (100, 2, 2, 0)])


def test_topk_like_sql(same_as_sql):
    same_as_sql(queries.op5_exact_topk, queries.OP5_SQL)


def test_bounds_hold():
    rnd = np.random.default_rng(1)
    x = rnd.integers(-2000, 2000, (300, 16))
    pivots = topk.farthest_first(x, 8)
    t, norm = topk.distances(x, pivots), (x.astype(float) ** 2).sum(axis=1)
    assert (topk.upper_bounds(t, norm, t, norm) >= x @ x.T).all()


# ---------------------------------------------------------------- 6 and 7


def ids_of(text, path):
    return tokenizer(path).encode(text, add_special_tokens=False).ids


def test_bpe_like_the_library(documents):
    docs = documents(7)
    path = bpe.vocabulary()
    out = bpe.decode(bpe.encode(docs, mean=64))
    expected = [(d, list(ids_of(t, path)), tokenizer(path).decode(ids_of(t, path), skip_special_tokens=False)) for d, t in pairs_of(docs)]
    same_rows(out.select("doc_id", "ids", "decoded"), expected)
    same_rows(bpe.encode(docs, mean=64, decoded="text_").select("doc_id", "ids", "text_"), expected)


def test_bpe_of_nothing(no_documents, spark):
    assert bpe.decode(bpe.encode(no_documents)).count() == 0
    odd = spark.createDataFrame([([50256, 0],), ([],), (None,), ([447],)], "ids array<int>")
    assert [r.decoded for r in bpe.decode(odd).collect()] == ["<|endoftext|>!", "", "", chr(0xFFFD)]


ANY = st.lists(st.sampled_from([*"ab'stlm.,!? \n\t12é–’<|>日", "<|endoftext|>", "the ", "don't ", "É", " une"]), max_size=40).map("".join)


@settings(max_examples=150, deadline=None)
@given(ANY, st.lists(st.integers(0, 60), max_size=6))
def test_joins_are_repaired(text, cuts):
    path, data = bpe.vocabulary(), text.encode()
    edges = [0, *sorted({c for c in cuts if c < len(data) and (data[c] & 0xC0) != 0x80} - {0}), len(data)]
    pieces = {a << 32 | (b - a): np.array(ids_of(data[a:b].decode(), path), np.int32).tobytes() for a, b in zip(edges[::2], edges[1::2], strict=False) if a < b}
    assert bpe.assemble([data], [pieces], path)[0].tolist() == ids_of(text, path)


@settings(max_examples=300, deadline=None)
@given(st.lists(ANY, min_size=1, max_size=5))
def test_units(found):
    words = tokenfiles.vocabulary()
    for _, _, data, off in common.steps(pa.array(found)):
        flat, n = tokenfiles.encode_bytes(tokenfiles.worker_units(words, 1), data, off)
        assert [x.tolist() for x in np.split(flat, np.cumsum(n)[:-1])] == [[*ids_of(t, words), 1] for t in found]
    assert [x.tolist() for x in bpe.encode_all(found, bpe.vocabulary())] == [ids_of(t, bpe.vocabulary()) for t in found]


def test_token_files(documents, spark, tmp_path):
    docs = documents(8)
    folder = str(tmp_path / "ids")
    tokenfiles.write_ids(docs, folder)
    expected, start = [], 0
    order = F.xxhash64(F.coalesce("text", F.lit("")))
    rows = docs.orderBy(F.col("doc_id").asc_nulls_first(), order).collect()
    for r in rows:
        ids = [*ids_of(r.text or "", tokenfiles.vocabulary()), 1]
        expected.append((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    same_rows(tokenfiles.with_crc32(tokenfiles.read_ids(spark, folder)), expected)
    found = tokenfiles.read_ids(spark, folder, [3, 9])
    assert {r.doc_id for r in found.collect()} == {3, 9}
    assert "In(doc_id, [3,9])" in found._jdf.queryExecution().toString()
    import pyarrow.orc as orc

    files = [orc.ORCFile(str(f)) for f in (tmp_path / "ids").glob("*.orc")]
    assert sum(f.nrows for f in files) == len(rows) and all(f.row_index_stride == tokenfiles.ROW_INDEX for f in files)


def test_token_files_of_nothing(no_documents, spark, tmp_path):
    tokenfiles.write_ids(no_documents, str(tmp_path / "ids"))
    assert tokenfiles.read_ids(spark, str(tmp_path / "ids")).count() == 0


# ---------------------------------------------------------------- 9


def test_packing(documents):
    docs = documents(9)
    out = packing.pack(docs, capacity=300, shard_rows=40).collect()
    known = {r.doc_id: r for r in docs.collect()}
    total = Counter()
    bins = {}
    for r in out:
        total[r.doc_id] += r.size
        bins.setdefault((r.shard, r.bin), []).append(r)
    copies = Counter(r.doc_id for r in docs.collect())
    assert all(total[d] == copies[d] * len(known[d].text or "") for d in known)
    for pieces in bins.values():
        assert sum(p.size for p in pieces) <= 300
        at = sorted((p.offset, p.size) for p in pieces)
        assert all(a + s <= b for (a, s), (b, _) in zip(at, at[1:], strict=False))
        sources = [known[p.doc_id].source for p in pieces if known[p.doc_id].source]
        texts = [known[p.doc_id].text for p in pieces if known[p.doc_id].text]
        assert len(set(sources)) == len(sources) and len(set(texts)) == len(texts)


def test_near_copies_share_no_bin(spark, tmp_path):
    """The query keeps near copies apart, also where they share a doc_id or have none."""
    rnd = random.Random(9)
    base = prose(rnd, 60)
    rows = [(i if i < 4 else None if i < 6 else 7, f"{base} end{i}", f"s{i}") for i in range(8)] + [(10 + i, prose(rnd, 60), f"s{i}") for i in range(8)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    out = queries.op9_packing(spark, str(tmp_path)).collect()
    assert len(out) == len(rows)
    near = [(r.shard, r.bin) for r in out if r.doc_id is None or r.doc_id < 10]
    assert len(set(near)) == len(near) == 8


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10), st.integers(-1, 3), st.integers(-1, 3)), max_size=30))
def test_best_fit(items):
    """Each piece goes to the tightest open bin that fits and does not conflict."""
    bins, offsets = packing.best_fit(*(list(x) for x in zip(*items, strict=True)) if items else ([], [], []), 10)
    left, held = [], []
    for (size, source, cluster), b, offset in zip(items, bins, offsets, strict=True):
        fits = [i for i in range(len(left)) if left[i] >= size and not (source >= 0 and ("s", source) in held[i]) and not (cluster >= 0 and ("c", cluster) in held[i])]
        assert b == (min(fits, key=lambda i: (left[i], i)) if fits else len(left))
        if b == len(left):
            left.append(10)
            held.append(set())
        assert offset == 10 - left[b]
        left[b] -= size
        held[b] |= {("s", source), ("c", cluster)}


def test_packing_of_nothing(no_documents):
    assert packing.pack(no_documents).count() == 0


# ---------------------------------------------------------------- 10


def shingles(text, words):
    w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    return {tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set()


def near_rows(rows, words):
    """doc_id, n_shingles, component_id, kept of (doc_id, text) rows, null doc_ids among them."""
    sets, least = [shingles(t, words) for _, t in rows], {}
    for i in sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0)):
        todo = [] if i in least else [i]
        while todo:
            x = todo.pop()
            if x not in least:
                least[x] = rows[i][0]
                todo += [y for y in range(len(rows)) if y not in least and sets[x] and sets[y] and 100 * len(sets[x] & sets[y]) >= 80 * len(sets[x] | sets[y])]
    return [(d, len(sets[i]), least[i], d == least[i]) for i, (d, _) in enumerate(rows)]


def test_chains_over_rows_without_an_id(spark):
    """1 - null - 2: the ends are linked only by a row without a doc_id; components of such rows alone have no name and keep them."""
    words = [f"w{i}" for i in range(60)]
    first, middle, last = " ".join(words[:40]), " ".join(words[4:44]), " ".join(words[8:48])
    lone = " ".join(words[50:])
    rows = [(2, first), (None, middle), (1, last), (None, lone), (None, lone + " x"), (None, ""), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = minhash.near_duplicates(docs, 2).select("doc_id", "n_shingles", "component_id", "kept")
    same_rows(out, near_rows(rows, 2))
    assert {(r.doc_id, r.component_id) for r in out.where("n_shingles > 20").collect()} == {(2, 1), (None, 1), (1, 1)}
    left = minhash.first_of_each(docs, 2).collect()
    assert sorted((r.doc_id or 0, r.text) for r in left) == sorted([(0, middle), (1, last), (0, lone), (0, lone + " x"), (0, ""), (5, "")])


def test_lines_are_cut_in_one_pass(spark):
    """The time grows with a text's lines, not with their square."""
    import time

    n = 500_000
    rows = spark.range(1).select(F.array_join(F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: i.cast("string")), "\n").alias("t"), F.sequence(F.lit(0), F.lit(n - 1), F.lit(2)).alias("gone"))
    began = time.perf_counter()
    (row,) = rows.select(linedup._without("t", "gone").alias("x"), linedup._without("t", F.sequence(F.lit(0), F.lit(n - 1))).alias("y")).collect()
    assert row.x == "\n".join(map(str, range(1, n, 2))) and row.y is None and time.perf_counter() - began < 30


@pytest.mark.parametrize("words", [2, 5])
def test_minhash_like_brute_force(documents, words):
    docs = documents(10)
    expected = near_rows(pairs_of(docs), words)
    same_rows(minhash.near_duplicates(docs, words).select("doc_id", "n_shingles", "component_id", "kept"), expected)


def test_minhash_like_sql(same_as_sql):
    same_as_sql(queries.op10_minhash, queries.OP10_SQL)


def test_minhash_of_nothing(no_documents):
    assert minhash.near_duplicates(no_documents).count() == 0


def test_a_large_group_of_copies(spark):
    """A star of altered copies whose members are alike, but not enough, among themselves."""
    rnd = random.Random(3)
    base = prose(rnd, 300).split(" ")
    rows = [(0, " ".join(base))]
    for i in range(1, 120):
        own = list(base)
        for at in rnd.sample(range(len(own)), 12 if i % 4 else 40):
            own[at] = f"w{i}x{at}"
        rows.append((i, " ".join(own)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sets = {d: shingles(t, 2) for d, t in rows}
    linked = {d for d in sets if 100 * len(sets[0] & sets[d]) >= 80 * len(sets[0] | sets[d])}
    out = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs, 2).collect()}
    assert 50 < len(linked) < 119 and all((out[d] == 0) == (d in linked) for d in sets)


def test_parities_bound_the_difference():
    rnd = np.random.default_rng(2)
    a, b = rnd.integers(0, 2**63, 400).astype(np.uint64), rnd.integers(0, 2**63, 300).astype(np.uint64)
    p = minhash.parities(np.concatenate((a, np.concatenate((a[:200], b)))), np.array([400, 500]))
    assert sum(int(x).bit_count() for x in (p[0] ^ p[1]).view(np.uint64)) <= 500


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 50), (100, 60), (7, 7), (None, 1)], "a long, b long")
    got = {r.node: r.component for r in common.components(common.Scratch(spark), edges).collect()}
    assert got == {i: 0 for i in range(41)} | {50: 50, 60: 50, 100: 50}
