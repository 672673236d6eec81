from pyspark.sql import functions as F

from linkloom.functions.names import base_name
from linkloom.operators import recommend, refine

LINK = "src_id long, dst_id long, Purchaser string, Seller string, probability double"
PREDICTION = "gnn_prediction double, probability double"


def test_base_names(rows):
    cases = {
        "018f2b10979746da820c5269e4d87bb2 LLC": "018f2b10979746da820c5269e4d87bb2",
        "018f2b10979746da820c5269e4d87bb2 Ltd.": "018f2b10979746da820c5269e4d87bb2",
        "A, Inc. LLC": "A",
        "Zinc Inc": "Zinc",
        "  Acme GmbH,  ": "Acme",
        "Acme Company Holdings": "Acme Company Holdings",
        "Incline": "Incline",
        "LLC": "LLC",
        "": "",
        None: None,
    }
    df = rows("name string", [(k,) for k in cases]).select("name", base_name(F.col("name")).alias("b"))
    assert {r["name"]: r["b"] for r in df.collect()} == cases


def test_thresholds(rows):
    df = rows(LINK, [(1, 2, "a", "b", p) for p in (0.55, 0.5499, None, 0.9)])
    assert {r["probability"] for r in refine.confident_links(df).collect()} == {0.55, 0.9}
    assert [r["probability"] for r in refine.low_confidence_links(df).collect()] == [0.5499]


def test_each_party_is_cleaned_from_its_own_column(rows):
    row = refine.clean_parties(rows(LINK, [(1, 2, "a LLC", "b Inc", 0.6)])).first()
    assert (row["Purchaser"], row["Seller"]) == ("a", "b")


def test_refine_never_lowers_and_keeps_unknowns(rows):
    cases = [(None, 0.4, 0.4), (0.9, None, None), (0.9, 0.4, 0.9), (0.1, 0.4, 0.4), (0.4, 0.4, 0.4)]
    df = rows(PREDICTION + ", expected double", cases)
    refined = refine.refine_probability(df)
    assert "gnn_prediction" not in refined.columns
    assert all(r["probability"] == r["expected"] for r in refined.collect())


def test_triage_excludes_its_bounds(rows):
    df = rows(
        "Purchaser string, Seller string, " + PREDICTION,
        [("a", "b", g, p) for g, p in [(0.81, 0.59), (0.8, 0.59), (0.81, 0.6), (None, 0.5), (0.9, None)]],
    )
    assert [(r[2], r[3]) for r in refine.triage_candidates(df).collect()] == [(0.59, 0.81)]


def test_recommendations_name_a_provider_once(rows):
    df = rows(LINK, [(1, d, "", "", p) for d, p in [(7, 0.2), (7, 0.9), (8, 0.5), (9, 0.5), (6, 0.1)]])
    ranked = recommend.recommend_top_k(df, 3).orderBy("rank").collect()
    assert [(r["dst_id"], r["probability"]) for r in ranked] == [(7, 0.9), (8, 0.5), (9, 0.5)]


def test_distance_of_known_places(rows):
    place = "id long, lat double, lon double"
    links = rows("src_id long, dst_id long", [(1, 2), (1, 3)])
    near = recommend.nearby_links(
        links, rows(place, [(1, 48.8566, 2.3522)]), rows(place, [(2, 51.5074, -0.1278), (3, -48.0, 2.0)]), 400.0
    ).collect()
    assert [r["dst_id"] for r in near] == [2] and abs(near[0]["km"] - 343.6) < 1.0
