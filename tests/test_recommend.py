import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from almsflow.operators import ids as I, recommend as RC, sampling as SM, train as TR
from almsflow.plans import jobs as J
from almsflow.runtime import cut_lineage, remove


def vecs(spark, n, dim=8, seed=1):
    rnd = random.Random(seed)
    return spark.createDataFrame([(i, [float(rnd.gauss(0, 1)) for _ in range(dim)]) for i in range(n)], "id long, vec array<float>")


def expected_top(queries, candidates, k, exclude_self=False):
    q, c = ({r.id: np.array(r.vec) for r in df.collect()} for df in (queries, candidates))
    out = set()
    for a, v in q.items():
        best = sorted((-round(float(v @ w), 12), b) for b, w in c.items() if not (exclude_self and a == b))[:k]
        out |= {(a, rank, b) for rank, (_, b) in enumerate(best, 1)}
    return out


@pytest.mark.parametrize("block", [1000, 5, 2])
def test_top_k_equals_full_scan_for_any_blocking(spark, block):
    q, c = vecs(spark, 20), vecs(spark, 33, seed=2).union(vecs(spark, 3, seed=2).withColumn("id", F.col("id") + 100))
    got = {(r.query_id, r.rank, r.id) for r in RC.top_k(q, c, 6, candidate_block=block).collect()}
    assert got == expected_top(q, c, 6)  # copies of a vector: lower id first
    alike = {(r.query_id, r.rank, r.id) for r in RC.similar(q, 5).collect()}
    assert alike == expected_top(q, q, 5, exclude_self=True)
    assert {r.id for r in RC.similar(q, 5, among_first=4).collect()} <= {0, 1, 2, 3}


def test_top_k_ranks_on_exact_scores(spark):
    """Scores that differ in the eleventh decimal are no tie; ids decide only between equal scores."""
    v = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0 + 1e-11, 0.0]), (2, [1.0, 0.0])], "id long, vec array<double>")
    assert [r.id for r in RC.top_k(v.filter("id = 0"), v, 3).orderBy("rank").collect()] == [1, 0, 2]


def test_top_k_ships_candidates_once(spark):
    slots = spark.sparkContext.defaultParallelism
    c = vecs(spark, 8 * slots).withColumn("id", F.col("id"))
    plan = RC.top_k(vecs(spark, 3), c, 2, candidate_block=4)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode") == 1  # of the queries


def test_analysis_of_one_entity(spark):
    ids = spark.createDataFrame([(10 + i, i) for i in range(6)], "ein long, id long")
    v = vecs(spark, 6)
    row = RC.analyse(12, ids, v, 3).first()
    assert [(2, x.rank, x.ein - 10) for x in row.similar] == sorted(x for x in expected_top(v, v, 3, True) if x[0] == 2)
    assert (row.ein, row.id) == (12, 2) and RC.analyse(99, ids, v).count() == 0


def test_dense_ids(spark):
    rows = [(d, d * 7 % 5, float(d % 4)) for d in range(50)]
    df = spark.createDataFrame(rows, "donor_ein long, receiver_ein long, grant_amt double")
    got = {r.ein: r.id for r in I.dense_ids(df, "donor_ein").collect()}
    order = sorted(rows, key=lambda r: (-r[2], r[0]))
    assert got == {r[0]: i for i, r in enumerate(order)}


def plain_draw(a, b, seed):
    keys, left, right = (a & 0xFFFFFFFF, a >> 32), b & 0xFFFFFFFF, b >> 32
    for i, (multiplier, constant) in enumerate(zip(SM.MULTIPLIERS, SM.round_constants(seed))):
        left, right = right, left ^ ((((right ^ keys[i % 2] ^ constant) * multiplier) >> 15) & 0xFFFFFFFF)
    return left << 31 | right >> 1


def test_draws(spark):
    """The written generator, no shared draws of neighbours or of ids 2^31 - 1 or 2^32 apart, and uniform values."""
    ids = [0, 1, 2, 2**31 - 1, 2**31, 2**32, 2**33 + 5, 2**62]
    df = spark.createDataFrame([(a, b) for a in ids for b in range(500)], "a long, b long")
    got = {(r.a, r.b): r.x for r in df.withColumn("x", SM.draw(F.col("a"), F.col("b"), 42)).collect()}
    assert all(got[k] == plain_draw(*k, 42) for k in got) and len(set(got.values())) == len(got)
    many = spark.range(200_000).select(SM.draw(F.col("id") % 7 + 2**32, F.col("id"), 1).alias("x"))
    for part in (F.col("x") % 100, F.shiftright("x", 56) % 128, F.shiftright("x", 20) % 64):
        counts = [r.n for r in many.groupBy(part).agg(F.count(F.lit(1)).alias("n")).collect()]
        even = 200_000 / len(counts)
        chi = sum((n - even) ** 2 / even for n in counts)
        assert abs(chi - (len(counts) - 1)) < 5 * (2 * len(counts)) ** 0.5


def test_more_receivers_than_32_bits(spark):
    pairs = spark.createDataFrame([(d, d * 3) for d in range(200)], "donor_id long, receiver_id long")
    found = SM.negative_samples(pairs, 2**33)
    top = found.agg(F.count(F.lit(1)), F.max("receiver_id"), F.countDistinct("receiver_id")).first()
    assert top[0] == 1000 and 2**32 < top[1] < 2**33 and top[2] == 1000


def test_negative_sampling_stops(spark):
    n = 100
    pairs = [(0, r) for r in range(n)] + [(1, r) for r in range(97)] + [(2, 5)]
    df = spark.createDataFrame(pairs, "donor_id long, receiver_id long")
    runs = [SM.negative_samples(d, n, chunk=c).collect() for d, c in ((df, 4096), (df.repartition(7), 13))]
    assert sorted(runs[0]) == sorted(runs[1])  # any chunking or partitioning gives the same rows
    counts = {d: sum(1 for r in runs[0] if r.donor_id == d) for d in (0, 1, 2)}
    attempts = range(97 * 15)
    draw = lambda d, a: plain_draw(d, a, 42) % n
    assert counts[0] == 0 and counts[2] == 5
    assert counts[1] == min(97 * 5, sum(draw(1, a) >= 97 for a in attempts)) < 97 * 5
    assert not {tuple(r) for r in runs[0]} & set(pairs)


def test_unknown_identifier(spark):
    ids = spark.createDataFrame([(10 + i, i) for i in range(4)], "ein long, id long")
    v = vecs(spark, 4)
    with pytest.raises(ValueError):
        RC.recommend_one(99, ids, v, ids, v, 2)
    asked = spark.createDataFrame([(10,), (99,)], "ein long")
    lists = {r.query_ein: r.results for r in RC.recommend_lists(asked, RC.recommend(asked, ids, v, ids, v, 2)).collect()}
    assert lists[99] == [] and [x.rank for x in lists[10]] == [1, 2]


def test_training_lowers_loss_and_serves(spark, tmp_path):
    rows = [(d, 1000 + r, "x", float(1 + (d * r) % 9)) for d in range(60) for r in range(40) if d % 4 == r % 4]
    grants = spark.createDataFrame([(a, b, None, g) for a, b, _, g in rows], "ein long, recipient_ein long, inferred_ein long, grant_amt double")
    grants.write.parquet(str(tmp_path / "grants"))
    # task_rows forces block pairs to be shared by tasks, as a hot donor would
    s = TR.Settings(dim=8, epochs=5, batch=32, learning_rate=0.05, init_std=0.1, blocks=2, task_rows=600)
    history = J.run_train(spark, str(tmp_path / "grants"), str(tmp_path / "model"), s, negative_ratio=2).orderBy("epoch").collect()
    assert history[-1].val_loss < 0.6931 and history[-1].train_loss < history[0].train_loss
    tags = {p.name for p in (tmp_path / "model" / "vectors").iterdir() if p.is_dir()}
    assert tags == {"tag=best", "tag=final", "tag=epoch_1", "tag=epoch_5"}
    out = J.run_recommend(spark, str(tmp_path / "model"), spark.createDataFrame([(3,)], "ein long")).orderBy("rank").collect()
    assert len(out) == 10 and sum((r.ein - 1000) % 4 == 3 for r in out) >= 8


@pytest.mark.parametrize("share", [0, 0.15, 0.5, 1])
def test_exact_split(spark, share):
    rows = [(i, i % 7, i % 2) for i in range(101)] + [(500, 3, 1)] * 40
    df = spark.createDataFrame(rows, "donor_id long, receiver_id long, label int").repartition(3)
    got = SM.with_exact_split(df, share).collect()
    order = sorted(rows, key=lambda r: (plain_draw(r[0], r[1], 42), *r))
    n_val = math.ceil(len(rows) * share)
    assert sorted(tuple(r) for r in got) == sorted([(*r, "val" if k < n_val else "train") for k, r in enumerate(order)])
    assert SM.with_exact_split(df.limit(0), share).count() == 0
    plan = SM.with_exact_split(df, share)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan
    a, b = (sorted(map(tuple, SM.with_split(d).collect())) for d in (df, df.repartition(5)))
    assert a == b


def test_blocks_follow_the_number_of_entities():
    s = TR.Settings(dim=64)
    assert TR.block_count(1000, s) == TR.FEWEST_BLOCKS and TR.block_count(10, TR.Settings(blocks=3)) == 3
    n = TR.block_count(100_000_000, s)
    assert 100_000_000 / n * 64 * 12 <= TR.BLOCK_BYTES < 100_000_000 / (n - 1) * 64 * 12


def plain_training(samples, start, s):
    """One block pair trained batch by batch with Adam, vector by vector."""
    state = {k: [np.array(v, np.float32), np.zeros(s.dim, np.float32), np.zeros(s.dim, np.float32), 0] for k, v in start.items()}
    losses = []
    for epoch in range(1, s.epochs + 1):
        a, b, y = (np.array(x) for x in zip(*samples))
        n = -(-len(samples) // s.batch)
        number, lost = TR.batch_numbers(a, b, y, n, s.seed, epoch), 0.0
        for k in range(n):
            grads, own = {}, [x for x, m in zip(samples, number) if m == k]
            for d, r, label in own:
                left, right = state["d", d][0].astype(float), state["r", r][0].astype(float)
                score = left @ right
                lost += max(score, 0) - score * label + math.log1p(math.exp(-abs(score)))
                slope = (1 / (1 + math.exp(-score)) - label) / len(own)
                grads["d", d] = grads.get(("d", d), 0) + slope * right
                grads["r", r] = grads.get(("r", r), 0) + slope * left
            for key, g in grads.items():
                x = state[key]
                x[3] += 1
                x[1] = 0.9 * x[1] + 0.1 * g
                x[2] = 0.999 * x[2] + 0.001 * g * g
                x[0] = x[0] - s.learning_rate * (x[1] / (1 - 0.9 ** x[3])) / (np.sqrt(x[2] / (1 - 0.999 ** x[3])) + 1e-8)
        losses.append(lost / len(samples))
    return {k: x[0] for k, x in state.items()}, losses


@pytest.mark.parametrize("task_rows", [10**9, 300, 80])
def test_steps_equal_plain_adam_however_many_tasks_share_them(spark, tmp_path, task_rows):
    """One hot donor, one block pair: 1, 2 and 4 tasks take the steps of the plain version."""
    rnd = random.Random(3)
    samples = [(0 if rnd.random() < 0.6 else rnd.randrange(1, 20), rnd.randrange(40), rnd.randrange(2)) for _ in range(500)]
    samples += samples[:5]
    s = TR.Settings(dim=4, epochs=3, batch=64, learning_rate=0.05, init_std=0.3, blocks=1, task_rows=task_rows)
    df = spark.createDataFrame(samples, "donor_id long, receiver_id long, label int").repartition(3)
    donors, receivers = spark.range(20).repartition(2), spark.range(41)
    assert len(TR.shared_slots({0: 505}, 4, s) if 505 > task_rows else []) == {10**9: 0, 300: 2, 80: 4}[task_rows]
    history = TR.train(df, df.limit(50), donors, receivers, str(tmp_path / "model"), s).orderBy("epoch").collect()
    start = {(side, r.id): r.vec for side, ids in (("d", donors), ("r", receivers)) for r in TR.init_vectors(ids, side, s).collect()}
    want, losses = plain_training(samples, start, s)
    got = {(side, r.id): r.vec for side, side_df in zip("dr", TR.load_vectors(spark, str(tmp_path / "model"), "final")) for r in side_df.collect()}
    assert got.keys() == want.keys()
    assert max(np.abs(np.array(got[k]) - want[k]).max() for k in want) < 2e-4
    assert [r.train_loss for r in history] == pytest.approx(losses, rel=1e-4)


def test_shared_slots_fit_the_cluster():
    s = TR.Settings(task_rows=100, batch=10)
    assert TR.shared_slots({3: 1000}, 1, s) == [] and TR.shared_slots({3: 90}, 8, s) == []
    assert [x[:2] for x in TR.shared_slots({3: 250, 5: 10_000}, 8, s)] == [(3, 0), (3, 1), (3, 2), (5, 0), (5, 1), (5, 2), (5, 3)]
    assert TR.shared_slots({k: 1000 for k in range(9)}, 8, s) == []


def test_few_attempts_are_made_in_place(spark):
    """Donors with few pairs send no attempt through a shuffle, and draw what dealt attempts draw."""
    rnd = random.Random(5)
    pairs = [(d, rnd.randrange(60)) for d in range(40) for _ in range(rnd.randrange(1, 50))] + [(3, None), (None, 4), (7, -1), (7, 10**6)]
    df = spark.createDataFrame(pairs, "donor_id long, receiver_id long")
    a, b = (sorted(map(str, SM.negative_samples(df, 60, chunk=c).collect())) for c in (4096, 64))
    assert a == b
    some = spark.createDataFrame([p for p in pairs if p[0] is not None], "donor_id long, receiver_id long")
    assert "Generate" not in SM.negative_samples(some, 60)._jdf.queryExecution().optimizedPlan().toString()


def test_blocks_follow_the_number_of_samples():
    """Pairs of blocks that grow past a bound would be shared by tasks that meet at every batch."""
    assert TR.enough_blocks(4, 16 * TR.PAIR_ROWS) == 4 and TR.enough_blocks(4, 0) == 4
    n = TR.enough_blocks(4, 184 * TR.PAIR_ROWS)
    assert 184 / n**2 <= 1 < 184 / (n - 1)**2


def test_candidates_of_a_block_stand_in_memory_once():
    rnd = np.random.default_rng(2)
    held = [(rnd.permutation(10) * 3 + i, rnd.random((10, 4), np.float32)) for i in range(3)]
    want = {i: v for ids, values in held for i, v in zip(ids.tolist(), values.astype(np.float64).tolist())}
    ids, values = RC._block(held)
    assert held == [] and ids.tolist() == sorted(want) and values.tolist() == [want[i] for i in sorted(want)]


def test_training_leaves_the_model_only(spark, tmp_path, monkeypatch):
    """States of earlier strata and placed samples do not pile up, however many strata there are."""
    root, held = tmp_path / "shared", []
    monkeypatch.setattr(TR, "fresh_path", lambda spark, name: str(root / name))
    evaluate = TR.evaluate
    monkeypatch.setattr(TR, "evaluate", lambda *a: held.append(sorted(p.name for p in (root / "training").iterdir())) or evaluate(*a))
    rnd = random.Random(3)
    samples = spark.createDataFrame([(rnd.randrange(20), rnd.randrange(15), i % 2) for i in range(200)], "donor_id long, receiver_id long, label int")
    donors, receivers = (spark.range(n) for n in (20, 15))
    s = TR.Settings(dim=4, epochs=2, batch=32, blocks=3)
    history = TR.train(samples, samples.limit(40), donors, receivers, str(tmp_path / "model"), s)
    assert history.count() == 2 and held == [["samples", f"state-{epoch}-2"] for epoch in (1, 2)]
    assert not (root / "training").exists()
    assert [v.count() for v in TR.load_vectors(spark, str(tmp_path / "model"))] == [20, 15]


def test_shuffle_files_go_with_the_write(spark, tmp_path):
    kept = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None)
    wide = spark.range(1000).repartition(7, "id").groupBy((F.col("id") % 5).alias("k")).count()

    def files():
        local = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {f for f in local.mkString("\n").split("\n") if "shuffle" in f}

    before = files()
    copy = cut_lineage(wide, str(tmp_path / "copy"))
    assert files() <= before and sorted(r["count"] for r in copy.collect()) == [200] * 5
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) == kept
    remove(spark, str(tmp_path / "copy"))
    assert not (tmp_path / "copy").exists()
