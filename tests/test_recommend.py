import datetime as dt
import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shoplens.operators import knn, popularity, recommend, topk
from shoplens.operators import preferences as P
from shoplens.operators.knn import knn_candidates, knn_join

NOW = dt.datetime(2024, 1, 31)


def as_of():
    return F.lit(NOW)


def actions(spark, items):
    """(user, product, type, minutes before NOW); later items arrive later."""
    data = [(i, u, p, t, NOW - dt.timedelta(minutes=m)) for i, (u, p, t, m) in enumerate(items)]
    return spark.createDataFrame(data, "event_id bigint, user_id bigint, product_id bigint, action_type string, ts timestamp")


def goods(spark, ids, **over):
    data = [(i, f"n{i}", over.get("category", {}).get(i, "C"), 1.0, over.get("stock", {}).get(i, 5), 1000 + i,
             over.get("vectors", {}).get(i)) for i in ids]
    return spark.createDataFrame(data, "product_id bigint, product_name string, category string, price float, stock int, "
                                       "created_at_ms bigint, product_vector array<float>")


def vectors(spark, table):
    return spark.createDataFrame([(k, v) for k, v in table.items()], "product_id bigint, product_vector array<float>")


def test_fold_counts_and_skips(spark):
    acts = actions(spark, [(1, 10, "SIGNUP", 9), (1, 11, "VIEW", 8), (1, 12, "CLICK", 7), (1, 13, "CLICK", 6), (2, 12, "VIEW", 5)])
    vecs = vectors(spark, {10: [0.0, 2.0], 11: [1.0, 0.0], 13: [1.0, 2.0, 3.0]})
    got = {r["user_id"]: r for r in P.preference_fold(acts, vecs, 2).collect()}
    assert set(got) == {1}  # user 2 only has a product without vector
    n = np.hypot(0.1, 0.9)
    assert got[1]["action_count"] == 2
    assert got[1]["preference_vector"] == pytest.approx([0.1 / n, 0.9 / n])
    attached = P.attach_vectors(acts, vecs, 2)
    assert attached.filter("skipped").count() == 3


def random_history(spark, users, n, products=12, dims=8, seed=3):
    rng = np.random.default_rng(seed)
    types = ["VIEW", "CLICK", "PURCHASE", "SIGNUP"]
    acts = actions(spark, [(int(rng.choice(users)), int(rng.integers(products)), types[rng.integers(4)], int(n - i))
                           for i in range(n)])
    vecs = vectors(spark, {p: rng.normal(size=dims).astype(float).tolist() for p in range(products - 1)})
    return acts, vecs


def result(df):
    return {r["user_id"]: (r["action_count"], np.array(r["preference_vector"])) for r in df.collect()}


def same(a, b):
    assert a.keys() == b.keys()
    for k in a:
        assert a[k][0] == b[k][0]
        assert np.allclose(a[k][1], b[k][1], atol=1e-9)


def test_fold_equals_array_twin_and_split_users(spark):
    # user 1 holds two thirds of all rows
    acts, vecs = random_history(spark, [1, 1, 1, 1, 2, 3], 900)
    plain = result(P.preference_fold(acts, vecs, 8))
    same(plain, result(P.preference_fold_in_arrays(acts, vecs, 8)))
    same(plain, result(P.preference_fold(acts, vecs, 8, hot_rows=100, segments=7)))
    assert all(abs(np.linalg.norm(v) - 1) < 1e-9 for _, v in plain.values())


def test_fold_split_into_tiny_segments_needs_many_rounds(spark):
    acts, vecs = random_history(spark, [1], 60)
    same(result(P.preference_fold(acts, vecs, 8)), result(P.preference_fold(acts, vecs, 8, hot_rows=10, segments=12)))


def test_fold_with_a_large_catalogue_joins_first(spark, monkeypatch):
    acts, vecs = random_history(spark, [1, 2, 3], 200)
    plain = result(P.preference_fold(acts, vecs, 8))
    monkeypatch.setattr(P, "fits_broadcast", lambda *a, **k: False)
    same(plain, result(P.preference_fold(acts, vecs, 8)))


def test_version_must_be_strictly_newer(spark, rows):
    stored = spark.createDataFrame([("a", "s", 7), ("b", "s", 5)], "user_id string, v string, updated_at long")
    incoming = spark.createDataFrame([("a", "x", 5, 1), ("a", "y", 7, 2), ("b", "p", 7, 3), ("b", "q", 7, 4), ("b", "r", 6, 5)],
                                     "user_id string, v string, updated_at long, seq long")
    assert rows(P.newest_version(stored, incoming, "user_id", "updated_at")) == [("a", "s", 7), ("b", "p", 7)]


def test_fallback_order(spark, rows):
    users = spark.createDataFrame([(1,), (2,), (3,), (4,)], "user_id long")
    t = lambda h: NOW - dt.timedelta(hours=h)
    primary = spark.createDataFrame([(1, [1.0], 5, t(1)), (2, [1.0], 5, t(24))],
                                    "user_id long, preference_vector array<double>, action_count long, updated_at timestamp")
    backup = spark.createDataFrame([(1, [2.0], 9), (2, [2.0], None), (3, [3.0], 4)],
                                   "user_id long, preference_vector array<double>, action_count long")
    got = rows(P.preference_with_fallback(users, primary, backup, as_of()), "user_id", "source", "action_count")
    assert got == [(1, "primary", 5), (2, "backup", 1), (3, "backup", 4), (4, "none", None)]


def test_viewed_takes_events_before_products(spark):
    acts = actions(spark, [(1, i % 60, "VIEW", 200 - i) for i in range(120)])
    got = recommend.recent_viewed(acts, as_of())
    assert got.count() == 60
    assert got.agg(F.max("rank")).first()[0] <= 100
    few = recommend.recent_viewed(actions(spark, [(1, 7, "CLICK", i) for i in range(150)] + [(1, 8, "VIEW", 5000)]), as_of())
    assert [r["product_id"] for r in few.collect()] == [7]


def test_popular_tiers_and_limit_before_join(spark, rows):
    bought = actions(spark, [(1, 1, "PURCHASE", 5), (2, 1, "PURCHASE", 5), (1, 99, "PURCHASE", 5), (2, 99, "PURCHASE", 4),
                             (1, 3, "PURCHASE", 3), (1, 4, "PURCHASE", 60 * 24 * 8), (1, 2, "VIEW", 1)])
    g = goods(spark, [1, 2, 3, 4])
    assert rows(popularity.popular_products(bought, g, as_of(), limit=3), "rank", "product_id") == [(1, 1), (3, 3)]
    seen = actions(spark, [(1, 2, "VIEW", 1), (1, 3, "CLICK", 1), (2, 3, "VIEW", 1), (1, 1, "PURCHASE", 60 * 24 * 9)])
    assert rows(popularity.popular_products(seen, g, as_of()), "rank", "product_id") == [(1, 3), (2, 2)]
    nothing = actions(spark, [(1, 2, "SEARCH", 1)])
    assert rows(popularity.popular_products(nothing, g, as_of(), limit=2), "rank", "product_id") == [(1, 4), (2, 3)]


def test_category_tiers_are_independent(spark, rows):
    g = goods(spark, [1, 2, 3, 4], category={1: "A", 2: "A", 3: "B", 4: "B"})
    acts = actions(spark, [(1, 1, "PURCHASE", 5), (1, 2, "VIEW", 5), (1, 3, "VIEW", 5)]).join(
        g.select("product_id", "category"), "product_id")
    got = rows(popularity.category_best(acts, g, as_of()), "category", "tier", "product_id")
    assert got == [("A", 1, 1), ("B", 2, 3)]


def test_knn_filters_and_ties(spark, rows):
    v = {i: [1.0, 0.0] for i in range(1, 8)}
    g = goods(spark, range(1, 8), vectors={**v, 7: [1.0, 0.0, 0.0]}, stock={1: None, 2: 0}, category={3: "D"})
    prefs = spark.createDataFrame([(1, [2.0, 0.0])], "user_id long, preference_vector array<double>")
    viewed = spark.createDataFrame([(1, 4)], "user_id long, product_id long")
    got = recommend.knn_recommend(prefs, g, 10, 2, category="C", viewed=viewed)
    assert rows(got, "rank", "product_id", "score") == [(1, 5, 1.0), (2, 6, 1.0)]
    assert recommend.clamp_limit(0) == 1 and recommend.clamp_limit(99) == 50


@pytest.mark.parametrize("block_rows,chunk_users,spread", [(1000, 1000, 1.0), (20, 7, 1.0), (15, 9, 0.05), (10, 100, 0.3)])
def test_knn_blocks_give_the_brute_force_result(spark, block_rows, chunk_users, spread):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(6, 8))
    item = {i: (centres[i % 6] + spread * rng.normal(size=8)).astype(np.float32).astype(float).tolist() for i in range(180)}
    item[17] = item[5]  # a tie
    taste = {u: (centres[u % 6] + 0.2 * rng.normal(size=8)).tolist() for u in range(25)}
    g = goods(spark, range(180), vectors=item, stock={i: i % 9 for i in range(180)})
    users = spark.createDataFrame([(u, t, [u, u + 6, 5] if u % 2 else None) for u, t in taste.items()],
                                  "user_id long, preference_vector array<double>, exclude array<bigint>")
    got = knn_join(users, knn_candidates(g, 8), 7, 8, block_rows=block_rows, chunk_users=chunk_users)
    found = {u: [] for u in taste}
    for r in got.orderBy("user_id", "rank").collect():
        found[r["user_id"]].append((r["product_id"], r["score"]))
    for u, t in taste.items():
        t = np.array(t)
        scores = []
        for i, v in item.items():
            if i % 9 == 0 or (u % 2 and i in (u, u + 6, 5)):
                continue
            v = np.array(v)
            scores.append((-(1 + t @ v / np.linalg.norm(t) / np.linalg.norm(v)) / 2, i))
        want = [(i, -s) for s, i in sorted(scores)[:7]]
        assert [i for i, _ in found[u]] == [i for i, _ in want]
        assert [s for _, s in found[u]] == pytest.approx([s for _, s in want])


def test_blocks_that_cannot_beat_the_kth_score_are_skipped(spark):
    rng = np.random.default_rng(11)

    def share(spread, dims=16, n=1500):
        centres = rng.normal(size=(30, dims))
        item = {i: (centres[i % 30] + spread * rng.normal(size=dims)).tolist() for i in range(n)}
        users = spark.createDataFrame([(u, (centres[u % 30] + spread * rng.normal(size=dims)).tolist(), None) for u in range(60)],
                                      "user_id long, preference_vector array<double>, exclude array<bigint>")
        stats = {}
        got = knn_join(users, knn_candidates(goods(spark, range(n), vectors=item), dims), 5, dims, block_rows=40, chunk_users=30, stats=stats)
        matrix = np.array([item[i] for i in range(n)], np.float32).astype(float)
        matrix /= np.linalg.norm(matrix, axis=1, keepdims=True)
        for r in users.collect()[:10]:
            scores = matrix @ (np.array(r["preference_vector"]) / np.linalg.norm(r["preference_vector"]))
            want = np.argsort(-scores, kind="stable")[:5].tolist()
            assert [x["product_id"] for x in got.where(f"user_id = {r['user_id']}").orderBy("rank").collect()] == want
        assert stats["pairs"] == 60 * n
        return stats["scored"] / stats["pairs"]

    assert share(0.15) < 0.2
    assert share(5.0) <= 1.0


def test_a_user_is_copied_once_a_round_however_small_blocks_are(spark, monkeypatch):
    rng = np.random.default_rng(7)
    item = {i: rng.normal(size=8).tolist() for i in range(600)}
    users = spark.createDataFrame([(u, rng.normal(size=8).tolist(), [u, u + 1]) for u in range(40)],
                                  "user_id long, preference_vector array<double>, exclude array<bigint>")
    sent, scored = [], knn._scored
    monkeypatch.setattr(knn, "_scored", lambda routed, *rest: sent.append(routed.count()) or scored(routed, *rest))
    groups = spark.sparkContext.defaultParallelism
    found = {}
    for block_rows in (1000, 3):
        got = knn_join(users, knn_candidates(goods(spark, range(600), vectors=item), 8), 5, 8, block_rows=block_rows, chunk_users=50)
        found[block_rows] = [tuple(r) for r in got.select("user_id", "rank", "product_id", "score").orderBy("user_id", "rank").collect()]
    assert found[3] == found[1000] and len(found[3]) == 200
    # Two hundred blocks or more, most of which a user asks for.
    assert len(sent) == 4 and max(sent) <= 40 * (groups + 1)


def test_knn_ranks_on_the_whole_score_and_takes_text_ids(spark):
    near = [math.cos(a) for a in (0.0, 4e-4, 3e-4)], [math.sin(a) for a in (0.0, 4e-4, 3e-4)]
    rows = [(f"PROD-{i}", 5, "C", [float(near[0][i]), float(near[1][i])]) for i in range(3)]
    g = spark.createDataFrame(rows, "product_id string, stock int, category string, product_vector array<double>")
    users = spark.createDataFrame([("USER-000001", [1.0, 0.0], ["PROD-0"]), ("USER-000002", [1.0, 0.0], None)],
                                  "user_id string, preference_vector array<double>, exclude array<string>")
    for block_rows in (None, 1):
        got = knn_join(users, knn_candidates(g, 2), 2, 2, block_rows=block_rows).orderBy("user_id", "rank").collect()
        assert [(r["user_id"], r["product_id"]) for r in got] == [
            ("USER-000001", "PROD-2"), ("USER-000001", "PROD-1"), ("USER-000002", "PROD-0"), ("USER-000002", "PROD-2")]
        assert 0 < got[0]["score"] - got[1]["score"] < 1e-7


def test_every_user_gets_a_strategy(spark):
    g = goods(spark, range(1, 6), vectors={i: [1.0, float(i)] for i in range(1, 6)})
    acts = actions(spark, [(1, 1, "PURCHASE", 5), (2, 2, "VIEW", 5), (3, 3, "VIEW", 5)])
    prefs = spark.createDataFrame([(1, [1.0, 0.0]), (3, [1.0])], "user_id long, preference_vector array<double>")
    users = spark.createDataFrame([(1,), (2,), (3,)], "user_id long")
    got = recommend.recommend_all(users, prefs, g, acts, as_of(), 2, 2)
    kinds = {(r["user_id"], r["strategy"]) for r in got.collect()}
    assert kinds == {(1, "knn"), (2, "popularity"), (3, "fallback")}
    with_cat = recommend.recommend_all(users, prefs, g, acts.withColumn("category", F.lit("C")), as_of(), 2, 2, category="C")
    assert {(r["user_id"], r["strategy"]) for r in with_cat.collect()} == {(1, "knn"), (2, "category_best"), (3, "fallback")}
    one = recommend.as_responses(got).filter("user_id = 1").first()
    assert [i["rank"] for i in one["recommendations"]] == [1, 2]


def test_clicks_in_a_category_lead_to_it(spark):
    rng = np.random.default_rng(1)
    centre = {"A": rng.normal(size=16), "B": rng.normal(size=16)}
    cat = {i: "A" if i < 30 else "B" for i in range(60)}
    item = {i: (centre[cat[i]] + 0.3 * rng.normal(size=16)).tolist() for i in range(60)}
    g = goods(spark, range(60), vectors=item, category=cat)
    acts = actions(spark, [(1, i, "CLICK", 20 - i) for i in range(10)])
    prefs = P.preference_fold(acts, g.select("product_id", "product_vector"), 16)
    got = recommend.knn_recommend(prefs, g, 10, 16, viewed=recommend.recent_viewed(acts, as_of())).collect()
    assert sum(r["category"] == "A" for r in got) >= 7
    assert not {r["product_id"] for r in got} & set(range(10))


def test_large_top_n_is_spread_without_loss(spark):
    df = spark.range(5000).select(F.lit(1).alias("k"), F.col("id"), (F.col("id") % 37).alias("n"))
    order = [F.desc("n"), F.asc("id")]
    spread = topk.top_per_group(df, ["k"], order, 1500, spread_by="id", salts=5)
    plain = topk.top_per_group(df, ["k"], order, 1500)
    assert spread.exceptAll(plain).isEmpty() and spread.count() == 1500


def test_all_rows_are_ranked_over_partitions(spark):
    df = spark.range(3000).repartition(7).select(F.col("id"), (F.col("id") % 41).alias("n"))
    order = [F.desc("n"), F.asc("id")]
    ranked = topk.top_overall(df, order, None)
    assert [r["rank"] for r in ranked.orderBy(*order).collect()] == list(range(1, 3001))
    assert "SinglePartition" not in ranked._jdf.queryExecution().executedPlan().toString().split("BroadcastExchange")[0]
    assert topk.top_overall(df.where("false"), order, None).count() == 0
    assert ranked.where("rank <= 50").exceptAll(topk.top_overall(df, order, 50)).isEmpty()


def test_pages(spark):
    df = spark.range(10)
    got = list(itertools.chain.from_iterable([r["id"] for r in topk.page(df, [F.asc("id")], p, 4).collect()] for p in range(3)))
    assert got == list(range(10))
