from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from seekframe.operators.fuse import label_lists, list_report, ranked_names, reciprocal_rank_fusion

SCHEMA = "query_id long, filename string, start long, rank long, note string"
KEY = ("filename", "start")


def listed(spark, names, query_id=1, note="x"):
    rows = [(query_id, n, 0, i, f"{note}{i}") for i, n in enumerate(names, 1)]
    return spark.createDataFrame(rows, SCHEMA)


def fuse(spark, lists, k=60, n=5):
    """Fusion of plain lists, one query."""
    hits = [listed(spark, names) for names in lists]
    rows = reciprocal_rank_fusion(hits, KEY, k, n).orderBy("rank").collect()
    return [(r.filename, r.score) for r in rows]


def expected(lists, k=60, n=5):
    scores, first = {}, {}
    for names in lists:
        for position, name in enumerate(names):
            scores[name] = scores.get(name, 0) + 1 / (k + position)
            first.setdefault(name, len(first))
    order = sorted(scores, key=lambda x: (-round(scores[x], 12), first[x]))
    return [(x, round(scores[x], 12)) for x in order[:n]]


def test_positions_count_from_zero_and_shared_keys_add_up(spark):
    assert fuse(spark, [["a", "b"], ["b", "c"]]) == [
        ("b", round(1 / 61 + 1 / 60, 12)),
        ("a", round(1 / 60, 12)),
        ("c", round(1 / 61, 12)),
    ]


def test_ties_keep_the_order_of_first_appearance(spark):
    assert [x for x, _ in fuse(spark, [["z", "y"], ["a", "b"]])] == ["z", "a", "y", "b"]


def test_key_twice_in_one_list_adds_twice(spark):
    assert fuse(spark, [["a", "b", "a"]])[0] == ("a", round(1 / 60 + 1 / 62, 12))


def test_payload_is_the_last_seen(spark):
    lists = [listed(spark, ["a", "b"], note="first"), listed(spark, ["b"], note="second")]
    rows = reciprocal_rank_fusion(lists, KEY, payload=("note",)).collect()
    assert {r.filename: r.note for r in rows} == {"a": "first1", "b": "second1"}


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from("abcdefgh"), min_size=1, max_size=6), min_size=1, max_size=3))
def test_fusion_matches_the_rule(spark, lists):
    assert fuse(spark, lists) == expected(lists)


def test_one_list_keeps_its_order_and_queries_are_apart(spark):
    hits = listed(spark, "cab").unionByName(listed(spark, "bd", query_id=2))
    rows = reciprocal_rank_fusion([hits], KEY, num_results=2).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.filename) for r in rows] == [(1, "c"), (1, "a"), (2, "b"), (2, "d")]


def test_reports(spark):
    lists = [listed(spark, ["b", "a", "b"]), listed(spark, ["c"])]
    rows = list_report(label_lists(lists), "filename").orderBy("list_no").collect()
    assert [r.names for r in rows] == ["a,b,b", "c"]
    assert ranked_names(lists[0], "filename").first().names == "b,a,b"
