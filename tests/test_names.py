"""Suggested and chained names against plain loops."""

import random

import pytest

from fathomframe.plans import check, names, study

TAXA = "family string, genus string, species string"
MAP = TAXA + ", new_family string, new_genus string, new_species string"


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(row[-1] + 1, last[j] + 1, last[j - 1] + (x != y)))
    return row[-1]


@pytest.mark.parametrize("distance", [0, 1, 2, 3])
def test_near_names_are_all_pairs(spark, distance):
    rng = random.Random(distance)
    words = ["".join(rng.choice("abé") for _ in range(rng.randrange(0, 9))) for _ in range(150)]
    other = ["".join(rng.choice("abé") for _ in range(rng.randrange(0, 9))) for _ in range(150)] + ["Chrysophrys auratus", "Pagrus auratus"]
    words += ["Chrysophrus auratus", "Pagrus aurtaus"]
    a, b = (spark.createDataFrame([(w,) for w in x], "name string") for x in (words, other))
    got = sorted(map(tuple, names.near_names(a, b, "name", distance).collect()))
    assert got == sorted((x, y, edits(x, y)) for x in set(words) for y in set(other) if edits(x, y) <= distance)


def test_best_suggestion_per_taxon(spark):
    known = spark.createDataFrame([("Sparidae", "Chrysophrys", "auratus"), ("Labridae", "Coris", "auricularis"), ("Other", "Coris", "auricularus"),
                                   ("Labridae", "Thalassoma", "lunare"), (None, "Thalassoma", "lutescens")], TAXA)
    obs = spark.createDataFrame([("Sparidae", "Chrysophrus", "auratus")] * 3 + [
        ("Labridae", "Coris", "auricularis"), ("Other", "coris", "auriculariss"), ("Labridae", "Thalasoma", "lunar"), ("X", "Nothing", "like it"),
        ("Labridae", "Thalasoma", "spp"), (None, "Thalassoma", "lutescans")], TAXA)
    got = {tuple(r)[:3]: tuple(r)[3:] for r in names.suggest_synonyms(obs, known).collect()}
    assert got == {("Sparidae", "Chrysophrus", "auratus"): (3, "Sparidae", "Chrysophrys", "auratus", 1),
                   ("Other", "coris", "auriculariss"): (1, "Labridae", "Coris", "auricularis", 1),
                   ("Labridae", "Thalasoma", "lunar"): (1, "Labridae", "Thalassoma", "lunare", 2),
                   (None, "Thalassoma", "lutescans"): (1, None, "Thalassoma", "lutescens", 1)}
    changed, report = check.apply_synonyms(obs, names.suggest_synonyms(obs, known).drop("rows", "distance"))
    assert changed.count() == obs.count() and report.count() == 4
    assert names.suggest_synonyms(obs.limit(0), known).collect() == [] == names.suggest_synonyms(obs, known.limit(0)).collect()


def test_ties_prefer_the_family(spark):
    known = spark.createDataFrame([("A", "Gen", "abb"), ("B", "Gen", "abc"), ("C", "Gen", "abd")], TAXA)
    obs = spark.createDataFrame([("B", "Gen", "abx"), ("Z", "Gen", "abx"), ("C", "Gen", "abb")], TAXA)
    got = {r.family: r.new_species for r in names.suggest_synonyms(obs, known, 1).collect()}
    assert got == {"B": "abc", "Z": "abb", "C": "abb"}


def test_reclassified(spark):
    known = spark.createDataFrame([("F", "New", "s"), ("F", "Newer", "s"), ("G", "Old", "s"), ("F", "Old", "t")], TAXA)
    obs = spark.createDataFrame([("F", "Old", "s"), ("F", "Old", "s"), ("F", "Old", "t"), (None, "Old", "s")], TAXA)
    got = sorted(map(tuple, names.suggest_reclassified(obs, known).collect()), key=str)
    assert got == sorted([("F", "Old", "s", 2, "F", "New", "s", "genus"), ("F", "Old", "s", 2, "F", "Newer", "s", "genus"),
                          ("F", "Old", "s", 2, "G", "Old", "s", "family"), (None, "Old", "s", 1, "G", "Old", "s", "family")], key=str)


@pytest.mark.parametrize("length", [1, 2, 3, 9, 33])
def test_chains_in_any_order(spark, length):
    links = [("F", "G", f"s{i}", None, None, f"s{i + 1}") for i in range(length)] + [("F", "G", "x", None, "H", None), (None, "N", "a", "F", "G", "s0")]
    random.Random(length).shuffle(links)
    table = spark.createDataFrame(links, MAP)
    got = {tuple(r)[:3]: tuple(r)[3:] for r in names.resolve_synonyms(table).collect()}
    end = ("F", "G", f"s{length}")
    assert got == {**{("F", "G", f"s{i}"): end for i in range(length)}, ("F", "G", "x"): ("F", "H", "x"), (None, "N", "a"): end}
    assert names.has_chains(table)


def test_no_chains_and_names_that_stay(spark):
    table = spark.createDataFrame([("F", "G", "a", "F", "G", "b"), ("F", "G", "c", "F", "G", "c"), ("F", "G", "d", None, None, "c")], MAP)
    assert sorted(tuple(r)[2:] for r in names.resolve_synonyms(table).collect()) == [("a", "F", "G", "b"), ("d", "F", "G", "c")]
    assert not names.has_chains(table)
    assert names.resolve_synonyms(table.limit(0)).collect() == []


@pytest.mark.parametrize("circle", [2, 3, 8])
def test_circles_are_named(spark, circle):
    links = [("F", "G", f"c{i}", None, None, f"c{(i + 1) % circle}") for i in range(circle)] + [("F", "G", f"t{i}", None, None, f"t{i + 1}" if i < 5 else "c0") for i in range(6)]
    links += [("F", "G", "fine", None, None, "end")]
    with pytest.raises(ValueError, match="circle") as error:
        names.resolve_synonyms(spark.createDataFrame(links, MAP))
    assert all(f"F G c{i}" in str(error.value) for i in range(circle)) and "t0" not in str(error.value) and "end" not in str(error.value)


def test_study_follows_chains(spark):
    life = spark.createDataFrame([("F", "G", "c", "NW", "FL", 1.0, 3.0, 1.0, 0.0, 100.0, "TL")], ", ".join(
        f"{c} {'double' if c in ('a', 'b', 'all', 'bll', 'fb_length_max') else 'string'}" for c in check.LIFE_HISTORY_COLUMNS))
    maxn = spark.createDataFrame([("k", "s", "F", "G", "a", "2")], "campaignid string, sample string, family string, genus string, species string, maxn string")
    length = spark.createDataFrame([("k", "s", "F", "G", "a", "50", "1", "1000")], "campaignid string, sample string, family string, genus string, species string, length string, number string, range string")
    synonyms = spark.createDataFrame([("F", "G", "b", None, None, "c"), ("F", "G", "a", None, None, "b")], MAP)
    _, checked = study.check_study(maxn, length, life, synonyms)
    assert [r.species for r in checked["checked.maxn"].collect()] == ["c"]
