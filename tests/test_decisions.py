"""Decision logs against a plain loop."""

import random

import pytest

from fathomframe.plans import decisions as D

LOG = "seq long, action string, campaignid string, sample string, family string, genus string, species string, length double, " + ", ".join(
    f"{n} {'double' if n == 'new_length' else 'string'}" for n in D.NEW)
ROWS = "campaignid string, sample string, family string, genus string, species string, length double, number double"


def brute(rows, log):
    last = {}
    for e in log:
        if e[2:8] not in last or last[e[2:8]][0] < e[0]:
            last[e[2:8]] = e
    out, used = [], set()
    for r in rows:
        for key in ((*r[:5], None), r[:6]):
            if key in last:
                used.add(key)
        said = last.get(r[:6] if r[5] is not None and r[:6] in last else (*r[:5], None))
        if said and said[1] == "drop":
            continue
        if said and said[1] == "set":
            new = said[8:]
            r = (*r[:2], *[n if n is not None else o for n, o in zip(new[:3], r[2:5])], new[3] if new[3] is not None else r[5], r[6])
        out.append(r)
    return sorted(out, key=repr), sorted((e for k, e in last.items() if k not in used), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_decisions_in_order(spark, seed):
    r = random.Random(seed)

    def keys():
        return ("c", r.choice("st"), r.choice(["F", None]), "G", r.choice("abc"))

    rows = [(*keys(), r.choice([None, 1.0, 2.0, 3.0]), float(i)) for i in range(80)]
    log = [(i, r.choice(D.ACTIONS), *keys(), r.choice([None, 1.0, 2.0, 9.0]), None, r.choice([None, "H"]), None, r.choice([None, 7.0])) for i in range(25)]
    df, entries = spark.createDataFrame(rows, ROWS), spark.createDataFrame(log, LOG)
    want, stale = brute(rows, log)
    assert sorted(map(tuple, D.apply_decisions(df, entries).collect()), key=repr) == want
    got = D.stale_decisions(df, entries).select("seq", "action", *D.KEYS, "length", *D.NEW)
    assert sorted(map(tuple, got.collect()), key=repr) == stale


def test_reports_become_decisions(spark):
    rows = spark.createDataFrame([("c", "s", "F", "G", "a", 5.0, 1.0), ("c", "s", "F", "G", "a", 6.0, 1.0), ("c", "s", "F", "G", "b", 5.0, 1.0)], ROWS)
    report = rows.filter("length = 6.0")
    assert D.apply_decisions(rows, D.as_decisions(report)).count() == 2
    by_taxon = D.as_decisions(report.drop("length"), seq=1)
    assert [x.species for x in D.apply_decisions(rows, by_taxon).collect()] == ["b"]
    maxn = rows.drop("length", "number").distinct()
    assert D.apply_decisions(maxn, by_taxon).count() == 1 and D.apply_decisions(maxn, D.as_decisions(report)).count() == 2
    assert D.stale_decisions(rows.filter("species = 'b'"), by_taxon).count() == 1
    kept = by_taxon.unionByName(D.as_decisions(report, "keep", 0))
    assert sorted(x.length for x in D.apply_decisions(rows, kept).collect()) == [5.0, 6.0]
    assert D.apply_decisions(rows, by_taxon.limit(0)).count() == 3 and D.apply_decisions(rows.limit(0), by_taxon).count() == 0


@pytest.mark.parametrize("entries,problem", [
    ([(1, "drop"), (1, "keep")], "contradictory"), ([(1, "burn")], "unknown action")])
def test_bad_logs_end_the_job(spark, entries, problem):
    log = spark.createDataFrame([(s, a, "c", "s", "F", "G", "a", None, None, None, None, None) for s, a in entries], LOG)
    rows = spark.createDataFrame([("c", "s", "F", "G", "a", 5.0, 1.0)], ROWS)
    with pytest.raises(Exception, match=problem):
        D.apply_decisions(rows, log).collect()
