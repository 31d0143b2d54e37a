"""Whitening, repair of conversations and the kNN join against brute force."""

import hashlib
import itertools
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from flatspan.llm import knn_join, repair, whitening

VECTOR = "vec_id long, embedding array<float>"
TURN = "conv_id long, turn long, role string, text string"


# --- whitening -------------------------------------------------------------------------------------


def spectra():
    rng = np.random.default_rng(0)
    for n in (1, 2, 3, 40):
        q, _ = np.linalg.qr(rng.standard_normal((n, n)))
        yield np.cov(rng.standard_normal((20 * n + 2, n)).T).reshape(n, n)
        yield np.diag(rng.integers(0, 3, n).astype(float))
        yield np.eye(n) * 7
        yield (lambda m: (m + m.T) / 2)(q @ np.diag(np.r_[np.ones(n // 2) * 5, np.logspace(-6, 3, n - n // 2)]) @ q.T)


@pytest.mark.parametrize("k", [1, 2, 12, 99])
def test_leading_eigen(k):
    for matrix in spectra():
        values, axes = whitening.leading_eigen(matrix, k)
        want = np.linalg.eigvalsh(matrix)[::-1][:k]
        size = max(want[0], 1e-9)
        assert len(values) == min(k, len(matrix)) and np.abs(values - want).max() <= 1e-13 * size
        assert np.abs(matrix @ axes - axes * values).max() <= 1e-13 * size
        assert np.abs(axes.T @ axes - np.eye(len(values))).max() <= 1e-12


def test_whitening(spark):
    rng = np.random.default_rng(4)
    vectors = (rng.standard_normal((300, 40)) @ rng.standard_normal((40, 40)) * 0.3).astype(np.float32)
    data = [(i, v.tolist()) for i, v in enumerate(vectors)] + [(7, vectors[7].tolist()), (None, vectors[3].tolist()), (400, vectors[5][:9].tolist()), (401, [])]
    odd = [(500, None), (501, [None, 1.0]), (502, [float("nan")]), (503, [float("inf")])]
    df = spark.createDataFrame(data + odd, VECTOR).withColumn("x", F.lit(1)).withColumn("n", F.lit("clash"))
    rows, dim = whitening.integers(df)
    model = whitening.fit_whitening(rows, dim)
    x = np.array([[int(np.floor(64 * float(c))) + 1_000_000 for c in [*v, *[0.0] * (40 - len(v))]] for _, v in data])
    n, sums = len(x), x.sum(axis=0)
    assert (model.n, model.sums) == (n, sums.tolist())
    centred = x - sums / n
    covariance = centred.T @ centred / n
    values = np.linalg.eigvalsh(covariance)[::-1][:32]
    assert np.allclose(model.values, values, rtol=1e-10) and np.isclose(model.trace, np.trace(covariance))
    done = whitening.whiten(rows, model)
    assert whitening.identity_error(done, n, 32) < 1e-6
    axes = model.axes / np.sqrt(values)
    want = sorted((str(i), int(d), *np.round(w, 6)) for (i, _), d, w in zip(data, ((n * x - sums) ** 2).sum(axis=1), centred @ axes, strict=True))
    got = sorted((str(r["vec_id"]), r["deviation"], *np.round(r["whitened"], 6)) for r in done.collect())
    assert [g[:2] for g in got] == [w[:2] for w in want] and np.allclose([g[2:] for g in got], [w[2:] for w in want], atol=1e-5)


def test_whitening_without_spread(spark, tmp_path):
    for data in ([], [(1, [0.5, 0.25])], [(i, [0.5, 0.25]) for i in range(9)], [(1, []), (2, None)]):
        spark.createDataFrame(data, VECTOR).write.mode("overwrite").parquet(f"{tmp_path}/embeddings.parquet")
        assert whitening.op11_whitening(spark, str(tmp_path)).count() == 0
    data = [(i, [i / 64, 2 * i / 64, 0.0]) for i in range(9)]  # one dimension only
    spark.createDataFrame(data, VECTOR).write.mode("overwrite").parquet(f"{tmp_path}/embeddings.parquet")
    out = whitening.op11_whitening(spark, str(tmp_path)).collect()
    assert len(out) == 9 and {(r["component"], r["n"]) for r in out} == {(1, 9)} and out[0]["identity_error"] < 1e-9 and abs(out[0]["explained"] - 1) < 1e-9
    assert {r["vec_id"]: r["deviation"] for r in out} == {i: 81 * 5 * (i - 4) ** 2 for i in range(9)}


def test_deviations_of_any_size():
    model = whitening.Whitening(10**9, [10**15 + 7, 3 * 10**15 + 1], 1.0, np.ones(1), np.ones((2, 1)))
    x = np.array([[10**6 + 1, 3 * 10**6], [10**6, 3 * 10**6 + 5]])
    want = [sum((model.n * int(c) - s) ** 2 for c, s in zip(v, model.sums, strict=True)) for v in x]
    assert list(whitening.deviations(x, model)) == want
    model.n, model.sums = 5, [5 * 10**6 + 2, 15 * 10**6 + 4]
    assert whitening.deviations(x, model).tolist() == [sum(int((5 * Fraction(int(c)) - s) ** 2) for c, s in zip(v, model.sums, strict=True)) for v in x]


# --- kNN join --------------------------------------------------------------------------------------


def brute_join(data, every, k):
    rows = [(i, [int(np.floor(64 * float(c))) for c in v]) for i, v in data if i is not None and v is not None and all(c is not None and np.isfinite(c) for c in v)]
    dot = lambda a, b: sum(x * y for x, y in itertools.zip_longest(a, b, fillvalue=0))
    out = []
    for at, (i, q) in enumerate(rows):
        if i % every == 0:
            best = sorted((-dot(q, v), j) for other, (j, v) in enumerate(rows) if other != at)[:k]
            out += [(i, rank, j, -s) for rank, (s, j) in enumerate(best, 1)]
    return sorted(out)


@pytest.mark.parametrize(("k", "groups", "shard", "pivots"), [(20, 8192, 65_536, 64), (3, 4, 50, 7), (5, 1, 9, 1)])
def test_knn_join(spark, k, groups, shard, pivots):
    rng = np.random.default_rng(6)
    centres = rng.standard_normal((9, 12))
    vectors = [(c + rng.standard_normal(12) * 0.2).astype(np.float32).tolist() for c in centres for _ in range(25)]
    data = list(enumerate(vectors)) + [(300 + i, vectors[3]) for i in range(60)]  # copies, more than any list
    data += [(20, vectors[20]), (20, vectors[20]), (40, vectors[0]), (500, [0.0] * 12), (501, []), (520, [1.0]), (521, [-9.0] * 12)]
    data += [(600, None), (601, [None]), (602, [float("nan")]), (603, [float("inf")]), (None, vectors[1])]
    df = spark.createDataFrame(data, VECTOR).withColumn("v", F.lit(1)).withColumn("place", F.lit("clash"))
    got = knn_join.knn_join(df, F.col("vec_id") % 5 == 0, k, pivots, groups, shard)
    assert got.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
    assert sorted(map(tuple, got.collect())) == brute_join(data, 5, k)


def test_knn_join_of_few_and_large(spark):
    join = lambda data: sorted(map(tuple, knn_join.knn_join(spark.createDataFrame(data, VECTOR), F.col("vec_id") % 20 == 0).collect()))
    assert join([]) == join([(1, [1.0])]) == join([(20, [1.0])]) == join([(0, None), (1, [1.0])]) == []
    large = [(i, [float(x) for x in v]) for i, v in enumerate(np.random.default_rng(1).integers(-(1 << 20), 1 << 20, (50, 5)))]
    assert join(large) == brute_join(large, 20, 20) and len(join(large)) == 60
    with pytest.raises(OverflowError):
        join([(0, [1e30]), (1, [1e30])])


def test_knn_join_sends_only_what_is_needed(spark):
    rng = np.random.default_rng(2)
    centres = np.eye(16) * 40
    data = [(i, (centres[i % 16] + rng.standard_normal(16)).tolist()) for i in range(1600)]
    rows, shape = knn_join.packed(spark.createDataFrame(data, VECTOR), F.col("vec_id") % 20 == 0)
    assert shape.dtype == "<i2"
    classes = rows.select("vec", F.array("vec_id").alias("ids")).withColumn("v", F.monotonically_increasing_id())
    pivots = knn_join.choose_pivots(classes, shape, 16)
    placed = knn_join.placed_queries(rows.where("chosen").withColumn("v", F.col("vec_id")), shape, pivots).toPandas()
    counts = np.bincount(placed["cell"], minlength=16)
    far = np.array([placed["gap"][placed["cell"] == c].max() if counts[c] else 0 for c in range(16)])
    reach = np.where(counts > 0, knn_join.kth_distances(classes, shape, pivots, 21) + 2 * far, -1)
    first, parts = knn_join.deal_cells(counts, pivots, 1)
    sent = knn_join.replicate(classes, shape, pivots, reach, first, np.ones_like(parts), 1).count()
    assert sent < 0.5 * len(data) * (counts > 0).sum()


# --- repair ----------------------------------------------------------------------------------------


def brute_repair(codes, entry=0, leaves=(0, 3)):
    """The least (cost, audit) by filling a table backwards; a pair of insertions at a place is enough."""
    follows = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    names = ["", "s", "u", "a"]
    need = lambda s: "a" if s == "u" else "u"

    def inserted(best):
        for _ in range(2):
            best = {s: min([x for x in (best[s], (lambda t: t and (t[0] + 2, "I" + t[1]))(best[need(s)])) if x] or [None]) for s in names}
        return best

    best = inserted({s: (0, "") if names.index(s) in leaves else None for s in names})
    for code in reversed(codes):
        now = {}
        for s in names:
            options = [(3, "D", s)]
            if code != "x":
                cut = int(code.isupper())
                if code.lower() in follows[s]:
                    options.append((cut, "K", follows[s][code.lower()]))
                options.append((2 + cut, "R", need(s)))
            now[s] = min([(c + best[t][0], e + best[t][1]) for c, e, t in options if best[t]] or [None])
        best = inserted(now)
    return best[names[entry]]


def test_search_finds_the_optimum():
    rng = np.random.default_rng(3)
    codes = [""] + ["".join(c) for n in (1, 2, 3) for c in itertools.product("xsuaoSUAO", repeat=n)]
    codes += ["".join(rng.choice(list(letters), int(rng.integers(4, 65)))) for letters in ("xsuaoSUAO", "ua", "u", "uuua", "so", "sxU", "uUaA") for _ in range(12)]
    for c in codes:
        found = [s for s in (repair.search(c, 0, f) for f in (0, 3)) if s]
        assert min(found) == brute_repair(c)
        if len(c) < 3 or len(c) > 50:
            for e in repair.STATES:
                for f in repair.STATES:
                    got = repair.search(c, e, f) if repair.can_reach(e, f) else None
                    assert got == brute_repair(c, e, (f,)), (c, e, f)


def test_lower_bounds_are_bounds():
    rng = np.random.default_rng(5)
    for _ in range(300):
        c = "".join(rng.choice(list("xsuaoSUAO"), int(rng.integers(1, 12))))
        for i, bound in enumerate(repair.lower_bounds(c)):
            assert bound <= min(x[0] for x in (brute_repair(c[i:], e, range(4)) for e in range(4)))


def brute_op12(turns):
    word = lambda x: " " if x is None else str(x)
    rows = {conv: [] for conv, *_ in turns}
    for conv, turn, role, text in turns:
        kind, role, text = zlib.crc32(f"{word(conv)}:{word(turn)}".encode()) % 20, word(role), word(text)
        if kind == 1:
            text = ""
        if kind == 2:
            text = text.translate(str.maketrans("", "", ".!?"))
        if kind == 4:
            role = "user"
        rows[conv] += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    out = []
    for conv, kept in rows.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0))
        faults, seen, codes = [], set(), ""
        for _, role, text in kept:
            shown = text.strip(" \t\n\x0b\f\r")
            fault = "blank" if not shown else "duplicate" if (role, text) in seen else "" if shown[-1] in ".!?" else "truncated"
            seen.add((role, text))
            faults.append(fault)
            first = role[:1] if role[:1] in ("s", "u", "a") else "o"
            codes += "x" if fault in ("blank", "duplicate") else first.upper() if fault else first
        numbers = [t for t, _, _ in kept if t is not None]
        initials = [r[:1] for _, r, _ in kept]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        cost, audit = brute_repair(codes)
        lines, at, state = [], 0, ""
        for edit in audit:
            need = "assistant" if state == "u" else "user"
            if edit == "I":
                lines.append(f"{need}:")
            elif edit != "D":
                lines.append(f"{kept[at][1] if edit == 'K' else need}:{kept[at][2]}")
            at += edit != "I"
            state = lines[-1][0] if lines else ""
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        out.append((conv, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("segment", [64, 2])
def test_repair(spark, tmp_path, segment, monkeypatch):
    monkeypatch.setattr(repair, "SEGMENT", segment)
    rng = np.random.default_rng(9)
    texts = ["Hello there.", "What?", "no end", " \t\n", "", "é!  \n", "Same.", "Same.", None, "dots. in. it", "x" * 100_000 + "."]
    roles = ["system", "user", "assistant", "user", "assistant", "tool", None, ""]
    turns = [(c, t, roles[rng.integers(len(roles)) if rng.random() < 0.3 else 1 + t % 2], texts[rng.integers(len(texts) - (c > 3))]) for c in range(90) for t in range(int(rng.integers(1, 9)))]
    turns += [(200, t, ("user", "assistant")[t % 2], f"turn {t % 70}." if t % 11 else "cut") for t in range(300)]
    turns += [(None, 0, "user", "Hi."), (None, None, "assistant", "Oh."), (300, None, "system", "Be kind.")]
    turns += [(c, 0, "system", "Alone.") for c in range(400, 460)] + [(c, t, "user", "Copy.") for c in range(500, 520) for t in (1, 4, 9)]
    df = spark.createDataFrame(turns, TURN).withColumn("key", F.lit(1)).withColumn("damage", F.lit("clash")).withColumn("pos", F.lit(2))
    df.repartition(5).write.parquet(f"{tmp_path}/conversations.parquet")
    out = repair.op12_repair(spark, str(tmp_path))
    assert [t for _, t in out.dtypes] == ["bigint"] * 7 + ["string"] * 2
    assert sorted(map(tuple, out.collect()), key=str) == brute_op12(turns)


def test_repair_of_nothing(spark, tmp_path):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    for turns in ([], [(gone, 0, "user", "Hi.")]):
        spark.createDataFrame(turns, TURN).write.mode("overwrite").parquet(f"{tmp_path}/conversations.parquet")
        got = list(map(tuple, repair.op12_repair(spark, str(tmp_path)).collect()))
        assert got == [(c, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest()) for c, *_ in turns]


def test_repaired_turns(spark):
    turns = [(1, 0, "user", "One."), (1, 1, "user", "Two."), (1, 2, "tool", "Three."), (1, 2, "tool", "Three."), (1, 3, None, None), (2, 0, "assistant", "Go")]
    rows = repair.ordered(spark.createDataFrame(turns, TURN))
    got = [tuple(r) for r in repair.repaired(rows, repair.repair_plans(rows)).orderBy("conv_id", "place").collect()]
    assert {g[0] for g in got} <= {1, 2} and [g[2][0] for g in got if g[0] == 1] in (["u", "a"], ["u", "a", "u", "a"])
    for conv in (1, 2):
        mine = [g for g in got if g[0] == conv]
        assert [g[1] for g in mine] == list(range(len(mine)))
