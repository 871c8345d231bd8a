from landing_helpers import landing_rows, ts

from farebox.operators import checks as chk


def test_generic_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (None, "zz"), (None, "zz")], "k int, v string")
    assert chk.check_not_null(df, "k").count() == 2
    u = chk.check_unique(df, "k").collect()
    assert [(r["unique_field"], r["n_records"]) for r in u] == [(1, 2)]     # NULLs are not duplicates
    acc = {r["value_field"]: r["n_records"] for r in chk.check_accepted_values(df, "v", ["a", "b"]).collect()}
    assert acc == {"zz": 2}                                                  # NULL passes
    parent = spark.createDataFrame([(1,)], "id int")
    rel = [r["from_field"] for r in chk.check_relationships(df, "k", parent, "id").collect()]
    assert rel == [2]                                                        # NULL fk ignored


def test_singular_checks(spark):
    trips = spark.createDataFrame([("t1", 5.0), ("t2", -1.0)], "trip_id string, duration_minutes double")
    assert [r[0] for r in chk.check_non_negative_duration(trips).collect()] == ["t2"]
    daily = spark.createDataFrame([(1,)], "trip_count long")
    bad = chk.check_totals_reconcile(trips, daily).collect()
    assert [(r["silver_count"], r["gold_count"]) for r in bad] == [(2, 1)]
    daily2 = spark.createDataFrame([(2,)], "trip_count long")
    assert chk.check_totals_reconcile(trips, daily2).count() == 0
    hourly = spark.createDataFrame([(0, 0), (3, 4), (2, 1)], "trip_count long, revenue_observation_count long")
    assert chk.check_gold_counts(hourly).count() == 2


def test_suite_counts_and_run(spark):
    suite = chk.default_suite()
    tests = [c.test for c in suite.checks]
    assert tests.count("not_null") == 47 and tests.count("unique") == 16
    assert tests.count("accepted_values") == 4 and tests.count("relationships") == 12
    assert tests.count("singular") == 4 and len({c.name for c in suite.checks}) == 83
    from farebox.plans.registry import Gold, models_of
    res = chk.run_checks(models_of(Gold(spark, "/root/testdata/sf0.001", materialize=True))).collect()
    assert len(res) == 83 and all(r["status"] == "PASS" for r in res)


def test_run_checks_reports_failures(spark):
    land = landing_rows(spark, [dict(service_type="taxi"), dict(service_type="yellow")])
    res = chk.run_checks({"landing": land}, chk.Suite().accepted("landing", "service_type", ["yellow"])
                         .not_null("landing", "pickup_datetime")).collect()
    got = {r["check_name"]: (r["failures"], r["status"]) for r in res}
    assert got == {"accepted_values__landing__service_type": (1, "FAIL"),
                   "not_null__landing__pickup_datetime": (2, "FAIL")}


def test_control_constraints(spark):
    files = spark.createDataFrame(
        [("tlc", "yellow", 2024, 1, "a", 10, 5, "VALIDATED"), ("tlc", "bus", 2008, 13, "a", -1, 5, "NOPE"),
         ("tlc", "yellow", 2024, 1, "a", 1, 1, "FAILED")],
        "source_kind string, service_type string, year int, month int, filename string, size_bytes long, "
        "row_count long, status string")
    got = {r["constraint_name"]: r["failures"] for r in chk.check_control_constraints("ingestion_files", files).collect()}
    assert got["service_type"] == 1 and got["year"] == 1 and got["month"] == 1 and got["size_bytes"] == 1
    assert got["status"] == 1 and got["unique_key"] == 1 and got["source_kind"] == 0


def test_unique_family_matches_separate_checks(spark):
    from pyspark.sql import functions as F
    base = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), ("b", None), ("c", None), ("c", None), (None, 1)],
                                 "k string, flag int")
    models = {"all": base, "flagged": base.filter("flag IS NOT NULL"), "unflagged": base.filter("flag IS NULL")}
    suite = chk.Suite().unique("all", "k").unique("flagged", "k").unique("unflagged", "k").not_null("flagged", "k")
    family = ("all", "k", {"all": None, "flagged": F.col("flag").isNotNull(), "unflagged": F.col("flag").isNull()})
    together = {r["check_name"]: r["failures"] for r in chk.run_checks(models, suite, [family]).collect()}
    apart = {r["check_name"]: r["failures"] for r in chk.run_checks(models, suite).collect()}
    assert together == apart == {"unique__all__k": 3, "unique__flagged__k": 1, "unique__unflagged__k": 1, "not_null__flagged__k": 1}


def test_every_kind_of_failure_is_counted_as_by_its_own_check(spark):
    child = spark.createDataFrame([(1, "x", 5), (1, "y", 7), (2, "x", None), (None, "z", 9), (None, None, 9)], "k int, v string, fk long")
    parent = spark.createDataFrame([(5, "a"), (6, "b"), (6, "b"), (None, "c")], "id int, name string")
    suite = (chk.Suite().not_null("child", "k", "v").unique("child", "k", "fk").accepted("child", "v", ["x"])
             .rel("child", "fk", "parent", "id").unique("parent", "id").not_null("parent", "name"))
    got = {r["check_name"]: (r["failures"], r["status"]) for r in chk.run_checks({"child": child, "parent": parent}, suite).collect()}
    want = {"not_null__child__k": chk.check_not_null(child, "k"), "not_null__child__v": chk.check_not_null(child, "v"),
            "unique__child__k": chk.check_unique(child, "k"), "unique__child__fk": chk.check_unique(child, "fk"),
            "accepted_values__child__v": chk.check_accepted_values(child, "v", ["x"]),
            "relationships__child__fk__parent": chk.check_relationships(child, "fk", parent, "id"),
            "unique__parent__id": chk.check_unique(parent, "id"), "not_null__parent__name": chk.check_not_null(parent, "name")}
    assert got == {name: (df.count(), "FAIL" if df.count() else "PASS") for name, df in want.items()}
    assert got["relationships__child__fk__parent"] == (3, "FAIL") and got["not_null__parent__name"] == (0, "PASS")


def test_suite_scans_each_model_once(spark, tmp):
    """Every stored model appears in one scan of the plan, and there is one exchange of pairs."""
    import re
    child = spark.range(100).selectExpr("id as k", "id % 3 as fk", "cast(id as string) as v")
    spark.range(3).write.parquet(f"{tmp}/parent")
    child.write.parquet(f"{tmp}/child")
    models = {m: spark.read.parquet(f"{tmp}/{m}") for m in ("child", "parent")}
    suite = chk.Suite().not_null("child", "k", "fk", "v").unique("child", "k").unique("child", "v").rel("child", "fk", "parent", "id").unique("parent", "id")
    plan = chk.run_checks(models, suite)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall("FileScan parquet", plan)) == 2 and len(re.findall(r"Exchange hashpartitioning\(check#\d+, key#\d+", plan)) == 1
