import re
from decimal import Decimal
from pathlib import Path

import pytest

from millrace import __main__ as command
from millrace.contract import GENERATION, PLANTS
from millrace.plans import migration
from millrace.plans.migration import Migration

HEADER = (
    "country,country_long,name,gppd_idnr,capacity_mw,latitude,longitude,primary_fuel,other_fuel1,commissioning_year,"
    "generation_gwh_2013,generation_gwh_2014,estimated_generation_gwh_2013,estimated_generation_note_2013,"
    "generation_data_source"
)
ROWS = [
    'USA,United States,"Big ""A"" plant",P1, 12 ,10.5,20.25,Coal,Peat,1998.9,1.5,,3,HYDRO-V1,src',
    "USA,United States,,P2,1e3,10.5,20.25,Gas,,NA,,,,,",
    "USA,United States,NA,P3,1d,10.5,20.25,Gas,,NA,5,6,,,",
    "USA,United States,neg,P4,0,10.5,20.25,Gas,,NA,5,6,,,",
    "USA,United States,Moor, Ada,P5,3,10.5,20.25,Gas,,NA,5,6,,,",
    "USA,United States,short,P6,2.675,90,20.25,Gas",
    "USA,United States,again,P1,2,1,20.25,Gas,,,9,8,,,",
    "FRA,France,long method,P7,5,1,2,Wind,,,7,8,," + "M" * 60 + ",s",
]


@pytest.fixture
def job(spark, tmp_path):
    source = tmp_path / "plants.csv"
    source.write_bytes("\r\n".join([HEADER, *ROWS, ""]).encode())
    return Migration(spark, str(source), str(tmp_path / "out"))


def rows_of(frame, *columns):
    return sorted(tuple(r) for r in frame.select(*columns).collect())


def quarantine(job, reason):
    return job.spark.read.parquet(job.path(f"quarantine/{reason}"))


def balanced(m):
    plants = ("errors", "broken", *[f"plants_{x}" for x in ("loaded", "conflicting", "merged", "known", "changed")])
    figures = [f"figures_{x}" for x in ("orphaned", "broken", "conflicting", "merged", "known", "changed")]
    return (
        sum(m[x] for x in plants) == m["plants_extracted"]
        and sum(m[x] for x in figures) + m["generation_records"] == m["figures_extracted"]
    )


def test_run_twice(job):
    first = job.run()
    assert first == {
        "plants_extracted": 8, "errors": 2, "broken": 1, "plants_loaded": 4, "generation_records": 3,
        "plants_conflicting": 1, "plants_merged": 0, "plants_known": 0, "plants_changed": 0,
        "figures_extracted": 9, "figures_orphaned": 4, "figures_broken": 1,
        "figures_conflicting": 1, "figures_merged": 0, "figures_known": 0, "figures_changed": 0,
    }
    assert balanced(first)
    plants = job.table(PLANTS)
    assert rows_of(plants, "id", "gppd_idnr", "capacity_mw") == [
        (1, "P1", Decimal("12.00")),
        (2, "P2", Decimal("1000.00")),
        (3, "P6", Decimal("2.68")),
        (4, "P7", Decimal("5.00")),
    ]
    assert rows_of(plants.where("id = 2"), "name", "commissioning_year") == [("Unknown", None)]
    # One row per plant and year, whichever copy of P1 it came from; P3..P5 have no parent.
    assert rows_of(job.table(GENERATION), "power_plant_id", "year", "generation_gwh") == [
        (1, 2013, Decimal("1.50")),
        (1, 2014, Decimal("8.00")),
        (4, 2014, Decimal("8.00")),
    ]
    assert rows_of(quarantine(job, "copies"), "gppd_idnr", "copies") == [("P1", 2)]
    assert rows_of(quarantine(job, "figures"), "gppd_idnr", "year") == [("P7", 2013)]
    bad = {r.reject_reason: r for r in quarantine(job, "rows").collect()}
    assert set(bad) == {"capacity_mw missing", "too many fields", None}
    assert bad["too many fields"].ragged_line == ROWS[4]
    assert bad[None].violations == ["capacity_positive"]

    second = job.run()
    assert second["plants_loaded"] == second["generation_records"] == 0 and balanced(second)
    assert (second["plants_known"], second["figures_known"]) == (4, 3)
    assert quarantine(job, "copies").where("copies = 2").count() == 2  # one row for each run
    assert job.table(PLANTS).count() == 4 and job.table(GENERATION).count() == 3


def test_later_file_adds_to_the_same_tables(job, tmp_path):
    job.run()
    more = tmp_path / "more.csv"
    lines = [
        "USA,United States,new,P0,1,1,1,Coal,,,4,,,,",
        "USA,United States,known,P2,,,,,,,4,,,,",
    ]
    more.write_text("\n".join([HEADER, *lines]))
    later = Migration(job.spark, str(more), job.target)
    assert later.run()["plants_loaded"] == 1
    assert rows_of(later.table(PLANTS).where("gppd_idnr = 'P0'"), "id") == [(5,)]
    # Figures find plants of an earlier load, even when the row itself is no valid plant.
    assert (2, 2013) in rows_of(later.table(GENERATION), "power_plant_id", "year")
    checks = later.validate()
    assert rows_of(checks["counts"], "check", "n_rows") == [
        ("countries", 2), ("generation_records", 5), ("power_plants", 5),
    ]
    for name in ("repeated_plants", "repeated_years", "orphans"):
        assert checks[name].count() == 0
    assert later.table(GENERATION).select("id").distinct().count() == 5


def test_stopped_between_parents_and_children_can_restart(job, monkeypatch):
    def stop(self, staged, ids):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(Migration, "_load_generation", stop)
        with pytest.raises(RuntimeError):
            job.run()
    # Plants were written, but no version names them.
    assert job.table(PLANTS).count() == 0 and job.store.numbers() == []
    done = job.run()
    assert (done["plants_loaded"], done["generation_records"]) == (4, 3)
    assert job.store.numbers() == [1] and len(job.store.vacuum()) == 2
    assert job.table(PLANTS).count() == 4 and job.table(GENERATION).count() == 3


def test_a_load_killed_between_the_tables_leaves_the_old_version_whole(job, tmp_path, monkeypatch):
    job.run()
    before = {t.name: sorted(map(str, job.table(t).collect())) for t in (PLANTS, GENERATION)}
    more = tmp_path / "more.csv"
    more.write_text("\n".join([HEADER, "USA,United States,new,P0,1,1,1,Coal,,,4,,,,", "USA,United States,other,P2,7,1,1,Gas,,,4,,,,"]))
    later = Migration(job.spark, str(more), job.target, update=True)

    def stop(self, staged, ids):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(Migration, "_load_generation", stop)
        with pytest.raises(RuntimeError):
            later.run()
    assert before == {t.name: sorted(map(str, later.table(t).collect())) for t in (PLANTS, GENERATION)}
    done = later.run()
    assert (done["plants_loaded"], done["plants_changed"], done["generation_records"]) == (1, 1, 2)
    assert rows_of(later.table(PLANTS).where("gppd_idnr IN ('P0', 'P2')"), "id", "gppd_idnr", "capacity_mw") == [
        (2, "P2", Decimal("7.00")),
        (5, "P0", Decimal("1.00")),
    ]
    assert sorted(map(str, later.table(PLANTS, version=1).collect())) == before[PLANTS.name]


def test_dry_run_writes_nothing(job, tmp_path):
    assert job.run(dry_run=True) == {"plants_extracted": 8, "errors": 2, "broken": 1, "figures": 9}
    assert not (tmp_path / "out").exists()


def test_a_hot_natural_key_is_merged(spark, tmp_path):
    """A third of all rows repeat one plant."""
    lines = [f"USA,United States,n{i},{'HOT' if i % 3 == 0 else f'K{i}'},{i + 1},1,1,Coal,,,{i + 1},,,," for i in range(3000)]
    (tmp_path / "hot.csv").write_text("\n".join([HEADER, *lines]))
    job = Migration(spark, str(tmp_path / "hot.csv"), str(tmp_path / "out"))
    done = job.run()
    assert (done["plants_loaded"], done["generation_records"]) == (2001, 2001)
    assert rows_of(quarantine(job, "copies"), "copies") == [(1000,)]
    ids = job.table(PLANTS).selectExpr("min(id)", "max(id)", "count(DISTINCT id)").collect()[0]
    assert tuple(ids) == (1, 2001, 2001)


def test_command_line(job, capsys, monkeypatch):
    monkeypatch.setattr(command, "build_session", lambda: job.spark)
    command.main(["--source", job.source, "--target", job.target, "--validate"])
    out = capsys.readouterr().out
    assert "plants_loaded: 4" in out and "fuel_breakdown" in out


def test_list_filters_reach_the_loaded_table(job):
    from millrace.operators.paging import PlantFilter

    job.run()
    chosen = PlantFilter(country="usa", fuel="Gas", min_capacity=2.5, max_capacity=900).predicate()
    plan = job.table(PLANTS).where(chosen)._jdf.queryExecution().executedPlan().toString()
    assert "primary_fuel#" in plan[plan.index("PartitionFilters") : plan.index("PushedFilters")]
    pushed = plan[plan.index("PushedFilters") :]
    for part in ("EqualTo(country_code,USA)", "GreaterThanOrEqual(capacity_mw,2.50)", "LessThanOrEqual(capacity_mw,900.00)"):
        assert part in pushed
    assert job.table(PLANTS).where(chosen).count() == 1


def test_detail_of_one_plant_reads_only_its_figures(job):
    from millrace.operators import keys

    job.run()
    one = keys.lookup(job.table(PLANTS), "id", 1)
    columns = ["generation_gwh", "estimated_generation_gwh", "estimation_method"]
    detail = keys.nest(one, job.table(GENERATION), "id", "power_plant_id", columns, "year", "generation")
    plan = detail._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(id,1)" in plan and "EqualTo(power_plant_id,1)" in plan
    assert [g.year for g in detail.collect()[0].generation] == [2013, 2014]


def test_a_figure_wins_over_a_missing_one(spark, tmp_path):
    lines = ["FRA,France,a,A1,5,1,2,Wind,,,100,,,,", "FRA,France,a,A1,5,1,2,Wind,,,,,90,M,", "FRA,France,a,A1,5,1,2,Wind,,,100,,,,"]
    (tmp_path / "c.csv").write_text("\n".join([HEADER, *lines]))
    job = Migration(spark, str(tmp_path / "c.csv"), str(tmp_path / "out"))
    done = job.run()
    assert balanced(done) and (done["plants_merged"], done["figures_merged"], done["figures_conflicting"]) == (2, 1, 1)
    assert rows_of(job.table(GENERATION), "generation_gwh", "estimated_generation_gwh") == [(Decimal("100.00"), None)]
    lost = quarantine(job, "figure_conflicts")
    assert rows_of(lost, "generation_gwh", "estimated_generation_gwh", "n_rows") == [(None, Decimal("90.00"), 1)]


def test_changed_rows_are_reported(spark, tmp_path):
    (tmp_path / "a.csv").write_text(f"{HEADER}\nFRA,France,a,A1,30,1,2,Wind,,,7,,,,\n")
    (tmp_path / "b.csv").write_text(f"{HEADER}\nFRA,France,a,A1,555,1,2,Wind,,,9,,,,\n")
    Migration(spark, str(tmp_path / "a.csv"), str(tmp_path / "out")).run()
    job = Migration(spark, str(tmp_path / "b.csv"), str(tmp_path / "out"))
    done = job.run()
    assert balanced(done) and (done["plants_changed"], done["figures_changed"]) == (1, 1)
    assert rows_of(quarantine(job, "changed"), "gppd_idnr", "capacity_mw") == [("A1", Decimal("555.00"))]
    assert rows_of(quarantine(job, "changed_figures"), "year", "generation_gwh") == [(2013, Decimal("9.00"))]


def test_a_quoted_break_is_neither_cut_nor_miscounted(spark, tmp_path):
    head = "country,country_long,name,gppd_idnr,capacity_mw,latitude,longitude,primary_fuel,generation_gwh_2013,estimated_generation_note_2013"
    lines = [
        'USA,United States,a,K1,5,1,2,Gas,5,"note one',
        'note two"',
        'USA,United States,"b',
        "USA,United States,c,K3,5,1,2,Gas,5,x",
        'b",K2,5,1,2,Gas,6,',
    ]
    (tmp_path / "f.csv").write_bytes("\r\n".join([head, *lines, ""]).encode())
    job = Migration(spark, str(tmp_path / "f.csv"), str(tmp_path / "out"))
    done = job.run()
    assert balanced(done) and (done["plants_extracted"], done["errors"], done["plants_loaded"]) == (2, 0, 2)
    assert rows_of(job.table(PLANTS), "gppd_idnr", "name") == [("K1", "a"), ("K2", "b\r\nUSA,United States,c,K3,5,1,2,Gas,5,x\r\nb")]
    assert rows_of(job.table(GENERATION).where("estimation_method IS NOT NULL"), "estimation_method") == [("note one\r\nnote two",)]


def test_a_wide_row_is_typed_by_methods_that_the_jit_compiles(spark, tmp_path, capsys):
    """HotSpot leaves methods of more than 8000 bytes to its interpreter."""
    plants = [c for c in HEADER.split(",") if "gwh" not in c and "note" not in c]
    figures = [f"{m}_{y}" for m in ("generation_gwh", "estimated_generation_gwh", "estimated_generation_note") for y in range(2013, 2020)]
    source = tmp_path / "wide.csv"
    source.write_text(",".join([*plants, *figures]) + "\n")
    typed = Migration(spark, str(source), str(tmp_path / "out"))._typed()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        typed.explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < 8000


def test_a_first_load_is_not_compared(job, monkeypatch):
    stored = []
    write = migration.materialize
    monkeypatch.setattr(migration, "materialize", lambda df, label, **more: (stored.append(label), write(df, label, **more))[1])
    rows = [r.replace("P1", f"Q{i}") for i, r in enumerate(ROWS)]
    Path(job.source).write_text("\n".join([HEADER, *rows, ""]))
    first = job.run()
    assert balanced(first) and first["plants_loaded"] == 5 and "compared" not in stored
    second = job.run()
    assert balanced(second) and second["plants_known"] == 5 and second["plants_loaded"] == 0 and "compared" in stored
