"""Statistics of the whole table that only a part of it once stood for."""

from chronogeo.operators import report
from chronogeo.plans.queries import QUERIES


def test_samples_are_of_the_whole_table(spark):
    rows = [(f"e{k:02d}", "t" * 50, None if k % 2 else "b" * 80, "founding" if k % 3 else "event", f"{1500 + k}-01-01", "day" if k % 5 == 0 else "year", k / 100, "country" if k % 7 == 0 else None) for k in range(60)]
    e = spark.createDataFrame([*rows, ("n", "null", None, "founding", "1912-01-01", "year", None, None)], "id string, title string, blurb string, category string, date_start string, date_precision string, notability double, founding_kind string")
    assert [r.id for r in report.precision_samples(e).collect()] == [r[0] for r in reversed(rows) if r[5] == "year"][:10]
    got = report.unclassified_foundings(e).collect()
    assert [r.id for r in got] == [r[0] for r in reversed(rows) if r[3] == "founding" and r[7] is None][:20]
    assert {(len(r.title), len(r.blurb)) for r in got} == {(40, 70), (40, 6)}


def test_registered_samples(spark, sf):
    got = QUERIES["year_precision_samples"](spark, sf).collect()
    assert len(got) == 10 and {r.date_precision for r in got} == {"year"} and len({r.date_start[:4] for r in got}) > 1
    assert 0 < QUERIES["unclassified_foundings"](spark, sf).count() <= 20
