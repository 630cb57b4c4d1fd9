"""Search by stored indexes against scoring everything."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from headway.functions.texts import trigrams
from headway.operators import cells, name_index


# names

@pytest.fixture(scope="module")
def names(spark):
    draw = random.Random(4)
    syllables = ["ba", "ko", "ri", "tu", "mel", "san", "wick", "ham", "é", "street"]
    spelled = [" ".join("".join(draw.choices(syllables, k=draw.randint(1, 4))).title()
                        for _ in range(draw.randint(1, 3))) for _ in range(300)]
    rows = [(i, n, "x") for i, n in enumerate([*spelled, *spelled[:40], spelled[0].upper(), "", "--", None, "a", "ÉÉ"])]
    return spark.createDataFrame(rows, "id long, name string, size string").repartition(3)


@pytest.fixture(scope="module")
def index(spark, names, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("names"))
    name_index.write_name_index(name_index.index_names(names, "name"), root)
    return name_index.load_name_index(spark, root)


def scored(names, texts):
    """(text id, name id) -> shared and all pieces, every text against every name."""
    def pieces(df, key, column):
        return {r[0]: set(r[1] or ()) for r in df.select(key, trigrams(F.col(column))).collect()}

    a, b = pieces(texts, "text_id", "wanted"), pieces(names, "id", "name")
    return {(i, j): (len(x & y), len(x | y)) for i, x in a.items() for j, y in b.items() if x & y}


@pytest.mark.parametrize("threshold", [0.05, 0.3, 0.5, 0.6, 0.8, 1.0])
def test_similar_names_equal_scoring_every_pair(spark, names, index, threshold):
    draw = random.Random(7)
    held = [r["name"] for r in names.orderBy("id").limit(80).collect()]
    texts = [(i, n[:draw.randint(1, len(n))] + draw.choice(["", "x", " Ba"]), "y") for i, n in enumerate(held)]
    texts += [(100, ""), (101, None), (102, "Zzzz qqq"), (103, held[0].upper()), (104, held[0])]
    frame = spark.createDataFrame([(*t[:2], "y") for t in texts], "text_id long, wanted string, pieces string")
    found = name_index.similar_names(index, frame, "wanted", threshold)
    assert set(found.columns) == {"text_id", "wanted", "pieces", "id", "name", "size", "similarity"}
    got = {(r["text_id"], r["id"]): round(r["similarity"], 9) for r in found.collect()}
    expected = {p: round(c / n, 9) for p, (c, n) in scored(names, frame).items() if c / n >= threshold}
    assert got == expected


def test_few_pairs_are_compared(spark, names, index):
    texts = names.where("id < 200").select(F.col("id").alias("text_id"), F.concat("name", F.lit("x")).alias("wanted"))
    spelled = name_index._rarest_first(
        name_index._pieces(texts.select(F.lower("wanted").alias("spelling"))), index.often)
    compared = name_index.candidates(index, spelled, 0.8).count()
    pairs = spelled.count() * index.spellings.count()
    good = sum(1 for c, n in scored(names, texts).values() if c / n >= 0.8)
    assert good > 100 and compared < pairs / 50


def test_names_of_one_kind_meet_by_hashes_and_few_are_compared(spark):
    draw = random.Random(5)
    rows = [(i, f"large ring {draw.getrandbits(48):012x}") for i in range(800)]
    kin = spark.createDataFrame(rows, "id long, name string")
    texts = kin.select(F.col("id").alias("text_id"), F.concat("name", F.lit("x")).alias("wanted"))
    index = name_index.index_names(kin, "name")
    spelled = name_index._rarest_first(name_index._pieces(texts.select(F.lower("wanted").alias("spelling"))), index.often)
    pairs = name_index.candidates(index, spelled, 0.6)
    assert {f.dataType.simpleString() for f in pairs.schema} == {"bigint"}
    assert 800 <= pairs.count() < 1200
    found = name_index.similar_names(index, texts, "wanted", 0.6)
    assert found.where("text_id = id").count() == 800
    expected = sum(1 for c, n in scored(kin, texts).values() if c / n >= 0.6)
    assert found.count() == expected


def test_a_threshold_of_nothing_is_refused(index, names):
    with pytest.raises(ValueError):
        name_index.similar_names(index, names, "name", 0.0)


def test_an_empty_index_or_no_texts_give_no_rows(spark, names):
    none = name_index.index_names(names.where("id < 0"), "name")
    assert name_index.similar_names(none, names.select("name"), "name", 0.5).count() == 0
    some = name_index.index_names(names, "name")
    assert name_index.similar_names(some, names.where("id < 0").select(F.col("name").alias("wanted")), "wanted").count() == 0


# places

def metres(lat1, lon1, lat2, lon2):
    lat1, lon1, lat2, lon2 = map(math.radians, (lat1, lon1, lat2, lon2))
    half = math.sin((lat2 - lat1) / 2) ** 2 + math.cos(lat1) * math.cos(lat2) * math.sin((lon2 - lon1) / 2) ** 2
    return 2 * cells.EARTH_RADIUS * math.asin(min(1.0, math.sqrt(half)))


@pytest.fixture(scope="module")
def spots():
    draw = random.Random(3)
    spots = [(draw.uniform(-90, 90), draw.uniform(-180, 180)) for _ in range(1500)]
    spots += [(draw.uniform(-1, 1), 180 - abs(draw.gauss(0, 1))) for _ in range(150)]
    spots += [(draw.uniform(-1, 1), -180 + abs(draw.gauss(0, 1))) for _ in range(150)]
    spots += [(89.999 - abs(draw.gauss(0, 0.5)), draw.uniform(-180, 180)) for _ in range(200)]
    spots += [(-37.8 + draw.gauss(0, 0.1), 145 + draw.gauss(0, 0.1)) for _ in range(1000)]
    return [*spots, (90.0, 0.0), (-90.0, 12.0), (0.0, 180.0), (0.0, -180.0), (10.0, 20.0), (10.0, 20.0)]


@pytest.fixture(scope="module")
def places(spark, spots, tmp_path_factory):
    rows = [(f"S{i:05}", lat, lon) for i, (lat, lon) in enumerate(spots)]
    rows += [("none", None, 1.0), ("half", 1.0, None), ("beyond", 91.0, 0.0)]
    path = str(tmp_path_factory.mktemp("places")) + "/places"
    cells.write_places(spark.createDataFrame(rows, "stop_id string, stop_lat double, stop_lon double"), path)
    return cells.load_places(spark, path)


POINTS = [(-37.8, 145.0), (0.1, 179.99), (0.0, -180.0), (89.9, 10.0), (90.0, 0.0), (-89.5, -170.0), (45.0, 0.0)]


@pytest.mark.parametrize("lat, lon", POINTS)
def test_circles_and_nearest_equal_brute_force(places, spots, lat, lon):
    far = sorted((metres(lat, lon, y, x), f"S{i:05}") for i, (y, x) in enumerate(spots))
    for radius in (100.0, 20_000.0, 300_000.0, 15_000_000.0):
        found = [r["stop_id"] for r in cells.places_in_circle(places, lat, lon, radius).collect()]
        assert sorted(found) == sorted(s for d, s in far if d <= radius)
    for k in (1, 20, 10_000):
        found = cells.nearest_places(places, lat, lon, k).collect()
        assert [round(r["distance_m"], 3) for r in found] == [round(d, 3) for d, _ in far[:k]]


def test_a_circle_reads_a_small_part(places, physical):
    total = places.count()
    assert cells._covered(places, -37.8, 145.0, 2000).count() < total / 20
    assert cells._covered(places, 0.0, 180.0, 2000).count() < total / 20
    for lat, lon in POINTS:
        assert len(cells.key_ranges(lat, lon, 5000)) <= cells.MOST_CELLS
    assert "PushedFilters: [Or(" in physical(cells.places_in_circle(places, -37.8, 145.0, 2000))
