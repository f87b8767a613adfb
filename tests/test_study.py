import os
import uuid
from hashlib import md5

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fixtures import ticks
from tickforge import staging
from tickforge.functions.digests import first_digits
from tickforge.functions.times import DAY, HOUR, MINUTE
from tickforge.operators import asof, bars, report, study
from tickforge.schemas import OvernightCost

MONDAY = 20514 * DAY  # 2026-03-02
FREE = OvernightCost(0.0, 0.0)


def path(spark, legs):
    """Minutes of linear legs [(minutes, end price)] from 2000, a tick a minute, spread 0.20."""
    px, out = 2000.0, [2000.0]
    for n, end in legs:
        out += [px + (end - px) * (i + 1) / n for i in range(n)]
        px = end
    return ticks(spark, [(60 * i, p) for i, p in enumerate(out)], spread=0.20, start=MONDAY)


def judged(spark, legs, side="buy", horizons=(1,), cost=FREE):
    t = path(spark, legs)
    price = 2000.20 if side == "buy" else 2000.0
    entries = spark.createDataFrame([("X", 1, side, MONDAY, price)], "instrument string, entry_id long, side string, start_ts long, price double")
    return study.evaluate(entries, bars.both_sides(t, 60), cost, horizons).first()


def test_v_shape(spark):
    r = judged(spark, [(30, 1995), (60, 2010), (30, 2010)])
    assert r.mae_usd_oz == pytest.approx(5.20)
    assert r.horas_ate_verde == pytest.approx(51 / 60, abs=0.04)
    assert r.verde_em == {1.0: True}


def test_never_green_and_censored(spark):
    r = judged(spark, [(30, 1990), (60, 1990)], horizons=(1, 24))
    assert r.mae_usd_oz == pytest.approx(10.20) and r.horas_ate_verde is None
    assert r.verde_em == {1.0: False, 24.0: None}


def test_short_side_and_nights(spark):
    r = judged(spark, [(30, 2005), (60, 1990), (10, 1990)], side="sell")
    assert r.mae_usd_oz == pytest.approx(5.20) and r.verde_em[1.0]
    nights = lambda a, b, triple: spark.range(1).select((asof.nights(F.lit(b), 0, 21, triple) - asof.nights(F.lit(a), 0, 21, triple)).alias("n")).first().n
    assert nights(MONDAY + 22 * HOUR, MONDAY + 4 * DAY + 12 * HOUR, 2) == 5
    assert nights(MONDAY + 22 * HOUR, MONDAY + 4 * DAY + 12 * HOUR, None) == 3
    assert nights(MONDAY + 5 * DAY, MONDAY + 6 * DAY + 23 * HOUR, 2) == 0
    assert nights(MONDAY, MONDAY + 21 * HOUR, 2) == 1
    steps = asof.rollovers(MONDAY, MONDAY + 7 * DAY, spark, 21, 2).agg(F.sum("weight")).first()[0]
    assert steps == nights(MONDAY - 1, MONDAY + 7 * DAY, 2) == 7


def test_episodes(spark):
    rows = [(0, "buy"), (1, "buy"), (2, "buy"), (3, "sell"), (243, "sell")]
    e = spark.createDataFrame([(i, MONDAY + m * MINUTE, s) for i, (m, s) in enumerate(rows)], "entry_id long, ts_us long, side string")
    for gap, n in ((60, 3), (0.5, 5), (0, 5), (240, 2)):
        assert study.episodes(e, gap).agg(F.count_distinct("episode")).first()[0] == n
    far = spark.createDataFrame([(i, MONDAY + i * 2 * DAY, "buy") for i in range(5)], "entry_id long, ts_us long, side string")
    assert study.episodes(far, 4 * 24 * 60).agg(F.max("episode")).first()[0] == 1


def values(spark, a, b):
    rows = [(float(x), True, i % 5) for i, x in enumerate(a)] + [(float(x), False, i % 5) for i, x in enumerate(b)]
    return spark.createDataFrame(rows, "x double, is_a boolean, episode long")


def test_superiority(spark):
    p = lambda a, b: study.superiority(values(spark, a, b), "x", "is_a").first().p
    assert p([1, 2, 3], [1, 2, 3]) == pytest.approx(0.5) and p([1, 2], [3, 4]) == 1.0 and p([5], [1, 5]) == pytest.approx(0.25)
    assert p([1, float("nan"), float("inf")], [2]) == 1.0


def test_bootstrap(spark):
    r = study.bootstrap(values(spark, range(20), range(5, 25)), "x", "is_a", n=200).first()
    p = study.superiority(values(spark, range(20), range(5, 25)), "x", "is_a").first().p
    assert r.lo <= p <= r.hi and r.episodes == 5
    assert study.bootstrap(values(spark, [1], [2]), "x", "is_a").first().lo is None


def test_draws_match_cells_and_fall_back(spark):
    rows = [(MONDAY + h * HOUR, float(h % 11)) for h in range(24 * 7 * 12)]
    cand = study.with_cells(spark.createDataFrame(rows, "ts_us long, pre_range double"))
    cells = cand.collect()
    entries = cand.where(F.col("ts_us") % (5 * HOUR) == 0).limit(30).withColumn("entry_id", F.monotonically_increasing_id())
    for scheme in study.SCHEMES:
        drawn = study.draw(entries, cand, scheme, 7, seed=3).collect()
        assert len(drawn) == 30 * 7
        at = {c.ts_us: c for c in cells}
        for d in drawn:
            c = at[d.cand_bar]
            assert 0 <= d.cand_ts - d.cand_bar < MINUTE
            if scheme != "aleatorio":
                assert (c.weekday, c.hour) == (d.weekday, d.hour)
            if scheme == "volatilidade" and not d.fallback:
                assert c.decile == d.decile
        again = study.draw(entries.repartition(3), cand.repartition(9), scheme, 7, seed=3).collect()
        assert {(d.entry_id, d.draw, d.cand_ts) for d in drawn} == {(d.entry_id, d.draw, d.cand_ts) for d in again}
    lone = spark.createDataFrame([(1, MONDAY, None)], "entry_id long, ts_us long, pre_range double")
    assert all(d.fallback for d in study.draw(lone, cand.where("hour <> 0"), "horario", 3).collect())


def test_volatility_is_matched_inside_the_pool_of_the_hour(spark):
    week = 7 * DAY
    pool = [(MONDAY + week * i, float(i)) for i in range(60)]  # a full hour: deciles of six
    pool += [(MONDAY + HOUR + week * i, float(i) if i < 9 else float("nan")) for i in range(20)]  # nine finite: too few
    pool += [(MONDAY + 2 * HOUR + week * i, float(i)) for i in range(12)] + [(MONDAY + 2 * HOUR + week * 12, None)]  # one or two a decile: too few
    entries = [(1, MONDAY + 900 * week, 20.5), (2, MONDAY + HOUR, 3.0), (3, MONDAY + 2 * HOUR, 5.0), (4, MONDAY + 3 * HOUR, 20.5), (5, MONDAY, None), (6, MONDAY, 1e9)]
    cand = spark.createDataFrame(pool, "ts_us long, pre_range double")
    drawn = study.draw(spark.createDataFrame(entries, "entry_id long, ts_us long, pre_range double"), cand, "volatilidade", 200, seed=2).collect()
    got = {e: {((d.cand_bar - MONDAY) % week // HOUR, (d.cand_bar - MONDAY) // week) for d in drawn if d.entry_id == e} for e in range(1, 7)}
    flag = {e: {d.fallback for d in drawn if d.entry_id == e} for e in range(1, 7)}
    cuts = np.quantile(np.arange(60.0), np.arange(1, 10) / 10)
    decile = lambda x: int(np.searchsorted(cuts, x, side="right"))
    assert got[1] == {(0, i) for i in range(60) if decile(i) == decile(20.5)} and flag[1] == {False}
    assert got[6] == {(0, i) for i in range(60) if decile(i) == 9} and flag[6] == {False}
    assert got[5] <= {(0, i) for i in range(60)} and len(got[5]) > 40 and flag[5] == {True}
    assert got[2] == {(1, i) for i in range(20)} and flag[2] == {True}  # all of the hour, not finite ones too
    assert got[3] == {(2, i) for i in range(12)} and flag[3] == {True}  # the finite ones of the hour
    everywhere = [(0, i, float(i)) for i in range(60)] + [(1, i, float(i)) for i in range(9)] + [(2, i, float(i)) for i in range(12)]
    cuts = np.quantile([x for *_, x in everywhere], np.arange(1, 10) / 10)
    assert got[4] == {(h, i) for h, i, x in everywhere if decile(x) == decile(20.5)} and flag[4] == {True}  # an hour without a pool: the pool's deciles


def test_an_interval_needs_replicates_not_values(spark):
    rows = [(1.0, True, 0), (2.0, False, 0), (3.0, True, 1), (1.5, False, 1), (0.5, True, 2), (4.0, False, 2)]
    v = spark.createDataFrame(rows, "x double, is_a boolean, episode long")
    r = study.bootstrap(v, "x", "is_a", n=50).first()
    assert r.lo is not None and 0 <= r.lo <= r.hi <= 1 and r.episodes == 3
    assert study.bootstrap(v, "x", "is_a", n=9).first().lo is None


def test_deciles_are_linear_cuts(spark):
    rows = [(MONDAY + 7 * DAY * i, float(i)) for i in range(20)] + [(MONDAY + HOUR + 7 * DAY * i, float("nan")) for i in range(20)]
    out = {r.pre_range: r.decile for r in study.with_cells(spark.createDataFrame(rows, "ts_us long, pre_range double")).collect()}
    assert out[0.0] == 0 and out[19.0] == 9 and out[10.0] == 5


def test_synthetic_legs_across_blocks(spark):
    rows = [("A", i, 1 + i % 3, float(i)) for i in range(9000)] + [("A", 9000, 0, 5.0), ("B", 3, 2, 10.0)]
    got = study.synthetic(spark.createDataFrame(rows, "instrument string, leg long, seconds long, price double"), MONDAY, 4.0, 0.5)
    want, px = {0: 4.0}, 4.0
    for _, _, seconds, end in rows[:9000]:
        at = max(want)
        want |= {at + j: px + (end - px) * j / seconds for j in range(1, seconds + 1)}
        px = end
    a = {r.seq: r for r in got.where("instrument = 'A'").collect()}
    assert {n: r.bid for n, r in a.items()} == pytest.approx(want) and all(r.ts_us == MONDAY + n * 1_000_000 for n, r in a.items())
    assert [(r.seq, r.bid, r.ask) for r in got.where("instrument = 'B'").orderBy("seq").collect()] == [(0, 4.0, 4.5), (1, 7.0, 7.5), (2, 10.0, 10.5)]


def test_block_extremes_find_what_the_path_has(spark):
    rng = np.random.default_rng(5)
    cost = OvernightCost(0.4, -0.3, triple_weekday=2, rollover_hour=21)
    # Minutes of nine days with holes of all sizes: some minutes, hours, and a weekend.
    at = np.array([m for m in range(9 * 1440) if rng.random() < 0.4 and not (m // 60) % 7 == 3 and not 4 * 1440 < m < 6 * 1440])
    mid = 2000 + np.cumsum(rng.normal(0, 0.3, at.size))
    hi, lo = mid + rng.random(at.size), mid - rng.random(at.size)
    b = spark.createDataFrame([("X", MONDAY + int(m) * MINUTE, float(h), float(x), float(h) + 0.2, float(x) + 0.2) for m, h, x in zip(at, hi, lo)], "instrument string, ts_us long, bid_high double, bid_low double, ask_high double, ask_low double")
    which = rng.integers(0, at.size, 120)
    which[:3] = 0, at.size - 1, at.size - 2
    sides = [("buy", "sell")[i % 2] for i in range(which.size)]
    prices = [float(mid[i] + (1 if s == "buy" else -1) * rng.exponential(6)) for i, s in zip(which, sides)]
    e = spark.createDataFrame([("X", n, s, MONDAY + int(at[i]) * MINUTE, p) for n, (i, s, p) in enumerate(zip(which, sides, prices))], "instrument string, entry_id long, side string, start_ts long, price double")
    got = {r.entry_id: r for r in study.evaluate(e, b, cost, (5, 60, 100)).collect()}
    nights = lambda m: sum((1, 1, 3, 1, 1, 0, 0)[d % 7] for d in range(9) if d * 1440 + 21 * 60 <= m)
    late = 0
    for n, (i, s, p) in enumerate(zip(which, sides, prices)):
        span = [j for j in range(i, at.size) if at[j] <= at[i] + 6000]
        sign, rate = (1, 0.4) if s == "buy" else (-1, -0.3)
        gain = {j: hi[j] - p if s == "buy" else p - (lo[j] + 0.2) for j in span}
        paid = {j: (nights(at[j]) - nights(at[i])) * rate for j in span}
        green = next((j for j in span if gain[j] > 0), None)
        net = next((j for j in span if gain[j] - paid[j] > 0), None)
        end = span[-1] if green is None else green
        worst = min(lo[j] - p if s == "buy" else p - (hi[j] + 0.2) for j in span if j <= end)
        hours = lambda j: None if j is None else pytest.approx((at[j] - at[i]) / 60)
        r = got[n]
        assert (r.horas_ate_verde, r.horas_ate_verde_liq) == (hours(green), hours(net)), n
        assert r.mae_usd_oz == pytest.approx(max(0, -worst)) and r.swap_usd_oz == pytest.approx(paid[end])
        assert r.verde_em == {h: None if at[i] + 60 * h > at[-1] else green is not None and at[green] <= at[i] + 60 * h for h in (5.0, 60.0, 100.0)}
        late += green is not None and at[green] - at[i] > 1440
    assert late > 5
    with pytest.raises(ValueError):
        study.evaluate(e, b, cost, (5,), seconds=7)


def test_a_horizon_is_some_dozen_pieces(spark):
    spans = [(0, 10080), (59, 60), (17, 17), (60, 119), (59, 1441), (1439, 1440), (333, 9000), (1440, 2879), (61, 10141)]
    df = spark.createDataFrame(spans, "a long, b long").select("a", "b", study.pieces(F.col("a"), F.col("b"), 60).alias("p"))
    for r in df.collect():
        minutes = [m for x in r.p for w in ((1, 60, 1440)[x.level],) for m in range(x.lo * w, (x.hi + 1) * w)]
        assert minutes == list(range(r.a, r.b + 1)) and len(r.p) <= 60
        if r.b - r.a >= 10000:
            assert len(r.p) <= 12


def test_bootstrap_by_groups_and_blocks(spark, monkeypatch):
    rng = np.random.default_rng(1)
    rows = [(g, float(rng.integers(0, 12)) if rng.random() < 0.6 else 3.0, bool(rng.random() < 0.4), int(rng.integers(0, 9))) for g in ("p", "q") for _ in range(120)] + [("lone", 1.0, True, 0)]
    v = spark.createDataFrame(rows, "g string, x double, is_a boolean, episode long")
    whole = {r.g: r for r in study.bootstrap(v, "x", "is_a", n=40, seed=3, by=["g"]).collect()}
    monkeypatch.setattr(study, "BLOCK_VALUES", 3)
    monkeypatch.setattr(study, "BLOCK_ROWS", 5)
    assert {r.g: r for r in study.bootstrap(v, "x", "is_a", n=40, seed=3, by=["g"]).collect()} == whole
    alone = study.bootstrap(v.where("g = 'q'").drop("g"), "x", "is_a", n=40, seed=3).first()
    assert (alone.lo, alone.hi, alone.episodes) == (whole["q"].lo, whole["q"].hi, whole["q"].episodes) and whole["lone"].lo is None
    p = {r.g: r.p for r in study.superiority(v, "x", "is_a", ["g"]).collect()}
    for g in ("p", "q"):
        a, b = ([x for h, x, s, _ in rows if h == g and s == side] for side in (True, False))
        assert p[g] == pytest.approx(np.mean([(x < y) + (x == y) / 2 for x in a for y in b])) and whole[g].lo <= p[g] <= whole[g].hi


def test_report_has_every_figure(spark):
    rng = np.random.default_rng(2)
    entries = spark.createDataFrame([(i, MONDAY + i * 40 * MINUTE, "buy") for i in range(6)] + [(6, MONDAY + 9 * HOUR, "sell")], "entry_id long, ts_us long, side string")
    episode = [1] * 6 + [2]

    def result(at, **more):
        green = float(rng.integers(1, 30)) if rng.random() < 0.7 else None
        return more | dict(episode=episode[at], mae_usd_oz=float(rng.integers(0, 9)), horas_ate_verde=green, horas_ate_verde_liq=green, swap_usd_oz=0.5, verde_em={5.0: None if at == 6 else green is not None and green <= 5})

    kinds = "episode int, mae_usd_oz double, horas_ate_verde double, horas_ate_verde_liq double, swap_usd_oz double, verde_em map<double, boolean>"
    real = [result(i, entry_id=i) for i in range(7)]
    fake = [result(i, of=i, scheme=s, fallback=i == 2 and s == "horario") for s in study.SCHEMES for i in range(7) for _ in range(4)]
    r, d = spark.createDataFrame(real, "entry_id long, " + kinds), spark.createDataFrame(fake, "of long, scheme string, fallback boolean, " + kinds)
    out = report.report(entries, r, d, 60, entries.limit(3), n=20, horizons_h=(5,)).collect()
    got = {(x.bloco, x.medida, x.campo): x.valor for x in out}
    assert len(got) == len(out)
    assert got["real", "entradas", "n"] == 7 and got["real", "entradas", "fora_do_historico"] == 3 and got["aleatorio", "entradas", "n"] == 28
    assert (got["horario", "entradas", "recuos"], got["aleatorio", "entradas", "recuos"]) == (1, 0)
    assert got["episodios", "episodios", "n_efetivo"] == 2 and got["episodios", "episodios", "maior"] == 6 and got["episodios", "gap_5min", "n_efetivo"] == 7
    for block in ("real", *study.SCHEMES):
        mine = real if block == "real" else [x for x in fake if x["scheme"] == block]
        mae, green = [x["mae_usd_oz"] for x in mine], [x["horas_ate_verde"] for x in mine if x["horas_ate_verde"] is not None]
        assert [got[block, "mae_usd_oz", f] for f in ("n", "p50", "p90", "max")] == pytest.approx([len(mae), np.quantile(mae, 0.5), np.quantile(mae, 0.9), max(mae)])
        assert got[block, "horas_ate_verde", "n"] == len(green)
        known = [x["verde_em"][5.0] for x in mine if x["verde_em"][5.0] is not None]
        assert (got[block, "nao_virou_5h", "n"], got[block, "nao_virou_5h", "censuradas"]) == (len(known), len(mine) - len(known)) and got[block, "nao_virou_5h", "fracao"] == pytest.approx(np.mean([not k for k in known]))
        if block != "real":
            for m in ("mae_usd_oz", "horas_ate_verde"):
                a, b = ([x[m] for x in rows if x[m] is not None] for rows in (real, mine))
                assert got[block, m, "p_real_menor"] == pytest.approx(np.mean([(x < y) + (x == y) / 2 for x in a for y in b]))
            assert got[block, "mae_usd_oz", "ic95_min"] is None  # two episodes are too few


def test_draws_are_the_dice_and_travel_packed(spark):
    """A draw goes to its episode as four bytes, an episode carries a byte a replicate; no array of replicates a row."""
    import numpy as np
    from pyspark.sql import functions as F

    from tickforge.functions.values import dice

    n, total = 30, 5000
    rows = pd.DataFrame({"__all": 0, "episodes": total, "place": np.arange(total)})
    packed = pd.concat(study._draws(["__all"], n, 7)([rows]))
    assert packed["codes"].map(len).sum() == 4 * n * total
    times = pd.concat(study._times(["__all"], n)(r) for _, r in packed.groupby("__block"))
    assert times["times"].map(len).max() == n
    got = {(no, r): int(t) for no, ts in zip(times["no"], times["times"]) for r, t in enumerate(np.frombuffer(ts, np.uint8)) if t}
    draws = spark.range(total).select("id", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("r")).select(dice(total, F.lit(7), F.col("r"), F.col("id")).alias("no"), "r")
    assert got == {(r.no, r.r): r["count"] for r in draws.groupBy("no", "r").count().collect()}


def test_a_value_of_many_rows_is_split(spark, monkeypatch):
    rows = [(float(i % 3), i % 2 == 0, i // 2) for i in range(90)] + [(float(i), i % 2 == 0, i) for i in range(20)]
    v = spark.createDataFrame(rows, "x double, is_a boolean, episode long")
    whole = study.bootstrap(v, "x", "is_a", n=40, seed=3).first()
    monkeypatch.setattr(study, "BLOCK_ROWS", 8)  # the values 0, 1 and 2 have some 30 rows each
    assert study.bootstrap(v, "x", "is_a", n=40, seed=3).first() == whole


def test_entries_of_one_bar_and_price_are_judged_once(spark):
    t = ticks(spark, [(7 * i, 100 + (i * 5) % 11) for i in range(900)], instrument="X")
    cost = OvernightCost(buy=0.5, sell=-0.1, triple_weekday=2, rollover_hour=21)
    start = F.floor(F.col("ts_us") / MINUTE) * MINUTE
    few = t.where("seq in (20, 300)").select("instrument", F.lit("buy").alias("side"), start.alias("start_ts"), F.lit(104.5).alias("price"), F.col("seq").alias("of"))
    many = few.withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(50)))).withColumn("entry_id", F.col("of") * 100 + F.col("i"))
    out = study.evaluate(many, bars.both_sides(t, 60), cost, (1,))
    plan = out._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert not any("Aggregate" in x and "entry_id" in x for x in plan)
    one = {r.entry_id: r for r in study.evaluate(few.withColumn("entry_id", F.col("of")), bars.both_sides(t, 60), cost, (1,)).collect()}
    rows = out.collect()
    assert len(rows) == 100 == len({r.entry_id for r in rows})
    for r in rows:
        w = one[r.entry_id // 100]
        assert (r.mae_usd_oz, r.horas_ate_verde, r.horas_ate_verde_liq, r.swap_usd_oz, r.verde_em) == (w.mae_usd_oz, w.horas_ate_verde, w.horas_ate_verde_liq, w.swap_usd_oz, w.verde_em)


def test_a_block_of_draws_is_counted_once(spark, monkeypatch):
    """Packed rows grow with the episodes, and so do blocks: a count as long as a block for each row would be quadratic."""
    rows = pd.DataFrame({"__all": 0, "episodes": 9000, "place": np.arange(9000)})
    packed = pd.concat(study._draws(["__all"], 12, 5)([rows]))
    block = packed[packed["__block"] == 1]
    assert len(block) > 3
    calls, count = [], np.bincount
    monkeypatch.setattr(np, "bincount", lambda *a, **k: calls.append(1) or count(*a, **k))
    times = study._times(["__all"], 12)(block)
    assert len(calls) == 1 and sum(np.frombuffer(t, np.uint8).sum() for t in times["times"]) == block["codes"].map(len).sum() / 4


def test_groups_of_as_many_episodes_share_their_draws(spark, monkeypatch):
    rng = np.random.default_rng(8)
    rows = [(g, float(rng.integers(0, 40)), bool(rng.random() < 0.5), e) for g, many in (("p", 30), ("q", 30), ("r", 17)) for e in range(many) for _ in range(3)]
    v = spark.createDataFrame(rows, "g string, x double, is_a boolean, episode long")
    draws = study._draws  # watched in the workers, which leave what they drew in files
    folder = staging.shared_dir(spark) + "/draws-" + uuid.uuid4().hex
    at = folder.removeprefix("file://")
    os.makedirs(at)

    def watched(group, n, seed):
        run = draws(group, n, seed)

        def each(batches):
            for out in run(batches):
                with open(f"{at}/{uuid.uuid4().hex}", "w") as f:
                    f.write(str(out["codes"].map(len).sum() // 4))
                yield out

        return each

    monkeypatch.setattr(study, "_draws", watched)
    whole = {r.g: r for r in study.bootstrap(v, "x", "is_a", n=40, seed=3, by=["g"]).collect()}
    made = [int(open(f"{at}/{f}").read()) for f in os.listdir(at)]
    assert sum(made) == 40 * (30 + 17)
    monkeypatch.undo()
    for g in "pqr":
        alone = study.bootstrap(v.where(F.col("g") == g).drop("g"), "x", "is_a", n=40, seed=3).first()
        assert (alone.lo, alone.hi, alone.episodes) == (whole[g].lo, whole[g].hi, whole[g].episodes)


def test_a_replicate_is_its_draws_ranked(spark, monkeypatch):
    """Against the plain way: each replicate's episodes drawn by the digests, its pairs counted one by one; with large values and strips of few replicates."""
    rng = np.random.default_rng(4)
    rows = [(float(rng.integers(0, 6)), bool(rng.random() < 0.4), int(rng.integers(0, 7)) * 3) for _ in range(90)]
    n, names = 30, sorted({e for *_, e in rows})
    p = []
    for r in range(n):
        drawn = [names[int(md5(b"2|%d|%d" % (r, place)).hexdigest()[:15], 16) % len(names)] for place in range(len(names))]
        a, b = ([x for e in drawn for x, s, f in rows if f == e and s == side] for side in (True, False))
        p.append(np.mean([(x < y) + (x == y) / 2 for x in a for y in b]))
    v = spark.createDataFrame(rows, "x double, is_a boolean, episode long")
    for most in (study.BLOCK_ROWS, 8):
        monkeypatch.setattr(study, "BLOCK_ROWS", most)
        monkeypatch.setattr(study, "STRIP_BYTES", most)
        got = study.bootstrap(v, "x", "is_a", n=n, seed=2).first()
        assert (got.lo, got.hi, got.episodes) == (pytest.approx(np.quantile(p, 0.025)), pytest.approx(np.quantile(p, 0.975)), len(names))


def test_array_digests_are_those_of_texts(spark):
    for size, numbers in ((1, [0, 7, 9]), (6, [10, 99]), (7, [123456]), (40, [10**14, 10**15 - 1])):
        heads = [bytes(33 + (i + j) % 90 for j in range(size)) for i in range(3)]
        got = first_digits(heads, np.array(numbers))
        assert [[int(x) for x in row] for row in got] == [[int(md5(h + b"%d" % x).hexdigest()[:15], 16) for x in numbers] for h in heads]
    with pytest.raises(ValueError):
        first_digits([b"x" * 50], np.array([123456]))


def test_rolls_are_the_dice_of_every_scheme(spark):
    ids = ["7", "real/123456", "x" * 60, "å/9"]
    e = spark.createDataFrame([(i,) for i in ids], "entry_id string")
    k, seed = 12, 4
    got = {r.entry_id: list(r[study._rolls_of(k, seed)]) for r in study.with_rolls(e, k, seed).collect()}
    assert got == {i: [int(md5(f"{seed}|{salt}|{i}|{d}".encode()).hexdigest()[:15], 16) for salt in (1, 2) for d in range(1, k + 1)] for i in ids}
    pool = spark.createDataFrame([(MONDAY + i * HOUR, float(i % 7)) for i in range(400)], "ts_us long, pre_range double")
    entries = spark.createDataFrame([(i, MONDAY + i * HOUR, float(i)) for i in range(5)], "entry_id long, ts_us long, pre_range double")
    for scheme in study.SCHEMES:
        once, own = (study.draw(x, pool, scheme, k, seed=seed) for x in (study.with_rolls(entries, k, seed), entries))
        assert once.columns == own.columns and sorted(once.collect()) == sorted(own.collect())
        bars_of = {r.ts_us: i for i, r in enumerate(pool.orderBy("ts_us").collect())}
        if scheme == "aleatorio":
            for r in own.collect():
                assert bars_of[r.cand_bar] == values_dice(seed, 1, r.entry_id, r.draw) % 400 and r.cand_ts - r.cand_bar == values_dice(seed, 2, r.entry_id, r.draw) % 60 * 1_000_000


def values_dice(*parts):
    return int(md5("|".join(map(str, parts)).encode()).hexdigest()[:15], 16)


def test_counted_results_are_those_of_each_row(spark):
    rng = np.random.default_rng(6)
    kinds = "bloco string, mae_usd_oz double, horas_ate_verde double, horas_ate_verde_liq double, swap_usd_oz double, verde_em map<double, boolean>, n int"
    rows = []
    for i in range(60):
        green = float(rng.integers(1, 9)) if rng.random() < 0.7 else None
        rows.append(("a" if i % 3 else "b", float(rng.integers(0, 9)), green, None if i % 3 == 0 else green, 0.5, {5.0: None if i % 7 == 0 else green is not None and green <= 5}, int(rng.integers(1, 30))))
    few = spark.createDataFrame(rows, kinds)
    many = spark.createDataFrame([r for r in rows for _ in range(r[-1])], kinds).drop("n")
    key = lambda r: r.bloco
    assert sorted(study.summary(few, (5,), ["bloco"], "n").collect(), key=key) == sorted(study.summary(many, (5,), ["bloco"]).collect(), key=key)
    p = [study.superiority(x.withColumn("is_a", F.col("bloco") == "a"), "mae_usd_oz", "is_a", weight=w).first() for x, w in ((few, "n"), (many, None))]
    assert p[0] == p[1]
