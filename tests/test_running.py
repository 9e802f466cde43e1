"""Cells kept through changes against a full count."""

import random

from millrace.operators import running, stats

SCHEMA = "id bigint, country_code string, country string, primary_fuel string, commissioning_year int, capacity_mw decimal(12,2)"


def plants(spark, rows):
    from decimal import Decimal

    return spark.createDataFrame([(*r[:5], None if r[5] is None else Decimal(r[5])) for r in rows], SCHEMA)


def test_any_changes(spark):
    r = random.Random(3)

    def row(i):
        c = r.choice(["AAA", "BBB", None])
        return (i, c, c and c.lower(), r.choice(["Gas", "Coal", None]), r.choice([None, 1990, 2001]), r.choice([None, 1, 5, 5, 9]))

    now = {i: row(i) for i in range(60)}
    cells = running.cells_of(plants(spark, now.values()))
    for step in range(3):
        gone = r.sample(sorted(now), 20 if step < 2 else len(now))
        removed = [now.pop(i) for i in gone]
        added = [row(1000 * (step + 1) + i) for i in range(10)]
        now |= {a[0]: a for a in added}
        # Rows written anew are removed and added as they were.
        same = list(now.values())[:5]
        current = plants(spark, now.values())
        cells = running.updated_cells(cells, plants(spark, added + same), plants(spark, removed + same), current)
        assert sorted(map(str, cells.collect())) == sorted(map(str, running.cells_of(current).collect()))
        total = stats.summary_of(running.regrouped(cells, "country_code", "primary_fuel")).collect()
        assert total == stats.summary(current).collect()


def test_everything_removed(spark):
    rows = plants(spark, [(1, "AAA", "a", "Gas", 1990, 5)])
    cells = running.updated_cells(running.cells_of(rows), rows.limit(0), rows, rows.limit(0))
    assert cells.count() == 0 and stats.summary_of(running.regrouped(cells, *running.KEYS[:3])).collect()[0].total_plants == 0
