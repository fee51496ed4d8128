"""Top places from list heads against the whole ranking, for every setting of the weights."""

import itertools
import random

import pytest

from destrank.operators import interactive
from destrank.operators.interactive import RankedLists, write_ranked_lists
from destrank.operators.ranking import criterion_ranks, score_from_ranks, top_k

COLUMNS = ["city", "avg_temp_max", "avg_pop", "avg_humidity", "rank_temp", "rank_rain", "rank_humidity", "score"]


def means(spark, n, seed=1):
    rng = random.Random(seed)
    rows = [(f"c{i:04d}", rng.randint(0, 40) / 2, rng.randint(0, 9) / 10, float(rng.randint(20, 90))) for i in range(n)]
    return spark.createDataFrame(rows, "city string, avg_temp_max double, avg_pop double, avg_humidity double")


def shown(df):
    return [tuple(r) for r in df.select(*COLUMNS).collect()]


def test_all_settings(spark, tmp_out):
    ranks = criterion_ranks(means(spark, 3000)).checkpoint()
    write_ranked_lists(ranks, tmp_out)
    lists = RankedLists(spark, tmp_out)
    rows = [tuple(r) for r in ranks.select(*COLUMNS[:-1]).collect()]
    compared = 0
    for weights in itertools.product(range(11), repeat=3):
        best = lists._best([(c, w) for c, w in zip(interactive.CRITERIA, weights) if w], weights, 5) if any(weights) else None
        scored = sorted((-(r[4] * weights[0] + r[5] * weights[1] + r[6] * weights[2]), r[0]) for r in rows)[:5]
        if best is not None:
            compared += 1
            assert [(-score, r.city) for r, score in best] == scored, weights
    assert compared == 11**3 - 1  # all but the one without any weight
    assert lists.rows_read < 3 * 3000 and lists.whole_lists_read == 0
    print(f"rows read for {compared} settings: {lists.rows_read} of {3 * len(rows)} in the lists")
    for weights in [(5, 5, 5), (10, 0, 3), (0, 0, 0), (0, 7, 0)]:
        assert shown(lists.top(weights, 5)) == shown(top_k(score_from_ranks(ranks, weights), 5))


def test_one_setting_reads_only_heads(spark, tmp_out):
    write_ranked_lists(criterion_ranks(means(spark, 5000, 2)), tmp_out)
    lists = RankedLists(spark, tmp_out)
    assert lists.top((10, 0, 0), 5).count() == 5 and lists.rows_read <= 512
    before = lists.rows_read
    lists.top((7, 0, 0), 5)
    assert lists.rows_read == before  # the head is kept
    assert lists.lists["rank_temp"].where("position <= 64").count() == 64


def test_missing_ranks_ties_and_depth(spark, tmp_out, monkeypatch):
    rows = [("a", 1.0, 0.1, None), ("b", 2.0, 0.1, 5.0), ("b", 2.0, 0.1, 5.0), (None, 2.0, 0.1, 5.0), ("d", None, 0.2, 4.0)]
    ranks = criterion_ranks(spark.createDataFrame(rows, "city string, avg_temp_max double, avg_pop double, avg_humidity double"))
    write_ranked_lists(ranks, f"{tmp_out}/some")
    for k in (1, 2, 3, 4, 9):
        want = shown(top_k(score_from_ranks(ranks, (1, 2, 3)), k))
        assert shown(RankedLists(spark, f"{tmp_out}/some").top((1, 2, 3), k)) == want
        monkeypatch.setattr(interactive, "MAX_DEPTH", 0)  # no head is deep enough: the whole list
        lists = RankedLists(spark, f"{tmp_out}/some")
        assert shown(lists.top((1, 2, 3), k)) == want and lists.whole_lists_read == 1
        monkeypatch.undo()
    write_ranked_lists(ranks.limit(0), f"{tmp_out}/none")
    assert RankedLists(spark, f"{tmp_out}/none").top((1, 1, 1), 3).count() == 0
    with pytest.raises(ValueError):
        RankedLists(spark, f"{tmp_out}/some").top((11, 0, 0), 3)
