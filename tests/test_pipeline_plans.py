"""X15 end to end on the smoke fixtures, plus physical-plan properties."""

from __future__ import annotations

import tempfile

import pytest
from pyspark.sql import functions as F
from conftest import SMOKE_DIR

from spendlens import config as C
from spendlens.operators.publish import PublishTarget
from spendlens.operators.quality import QualityGateError
from spendlens.operators.rollup import campaign_rollup
from spendlens.plans.pipeline import build, run
from spendlens.session import Scratch, hadoop_path, shared_folder
from spendlens.sources import fixtures


def listing(spark, path) -> set[str]:
    fs, p = hadoop_path(spark, path)
    return {str(f.getPath()) for f in fs.listStatus(p)} if fs.exists(p) else set()


def _plan(df) -> str:
    """The formatted physical plan (what ``df.explain("formatted")`` prints)."""
    jvm = df.sparkSession._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_run_gate_and_publish(spark):
    cfg = fixtures.fixture_config()
    src = fixtures.load(spark, SMOKE_DIR)
    root = tempfile.mkdtemp(prefix="spendlens-run-")
    stamp = cfg.window.stamp()
    tc = PublishTarget("run_campaign", f"{root}/campaign_{stamp}.parquet", f"{root}/t/campaign")
    th = PublishTarget("run_channel", f"{root}/channel_{stamp}.parquet", f"{root}/t/channel")
    shared = shared_folder(spark)
    before = listing(spark, shared)
    run(spark, src, cfg, tc, th)
    assert listing(spark, shared) == before, "a run leaves nothing in the shared folder"
    published = spark.table("run_campaign")
    assert published.count() == build(src, cfg, Scratch(spark)).campaign.count() > 0
    # next day: the previous publication is the table just written -> passes the gate
    src.previous = published
    run(spark, src, cfg.with_window(cfg.window.shifted(1)), check_spend=True)
    # a previous publication with inflated installs fails it
    inflated = published.withColumn(C.INSTALL, (F.col(C.INSTALL) + 1000).cast("int"))
    src.previous = inflated
    with pytest.raises(QualityGateError):
        run(spark, src, cfg)
    src.previous = None


def test_fanout_error_policy(spark):
    from dataclasses import replace

    from spendlens.operators.precedence import FanOutError

    cfg = replace(fixtures.fixture_config(), fanout="error")
    with pytest.raises(FanOutError) as e:
        build(fixtures.load(spark, SMOKE_DIR), cfg, Scratch(spark))
    assert e.value.total >= len(e.value.shown) > 0 and all(r["MATCHES"] > 1 for r in e.value.shown)
    one = build(fixtures.load(spark, SMOKE_DIR), replace(cfg, fanout="collapse"), Scratch(spark)).enriched
    assert one.count() == one.select(*C.K5).distinct().count()
    with pytest.raises(ValueError):
        build(fixtures.load(spark, SMOKE_DIR), replace(cfg, fanout="other"), Scratch(spark))


def test_channel_sums_equal_campaign_sums(spark):
    cfg = fixtures.fixture_config()
    st = build(fixtures.load(spark, SMOKE_DIR), cfg, Scratch(spark))
    a = st.campaign.groupBy().sum(*C.METRICS).collect()[0]
    b = st.channel.groupBy().sum(*C.METRICS).collect()[0]
    assert tuple(a) == tuple(b)


def test_plan_pushdown_pruning_no_cartesian_no_python(spark):
    cfg = fixtures.fixture_config()
    src = fixtures.load(spark, SMOKE_DIR)
    plan = _plan(campaign_rollup(src.fact, cfg))
    pushed = [line for line in plan.splitlines() if "PushedFilters" in line]
    assert pushed, plan
    assert "EqualTo(MVP_CAMPAIGN_TYPE,New Installs)" in pushed[0]
    assert "In(APPLICATION_FAMILY_NAME" in pushed[0] and "GreaterThanOrEqual(CALENDAR_DT" in pushed[0]
    full = _plan(build(src, cfg, Scratch(spark)).channel)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in full
    # the projection history is read with only the columns the job needs
    from spendlens.operators.rollup import install_ltv_rollup

    p = _plan(install_ltv_rollup(src.installs, src.projections, cfg))
    assert "IAP_PROJECTEDREVENUE_365" not in p


def test_merge_joins_without_extra_shuffle(spark):
    """Both sides of the K6 merge are aggregates on K6: no exchange directly under the join."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        cfg = fixtures.fixture_config()
        src = fixtures.load(spark, SMOKE_DIR)
        from spendlens.operators.merge import merge_details
        from spendlens.operators.rollup import install_ltv_rollup

        d = merge_details(campaign_rollup(src.fact, cfg), install_ltv_rollup(src.installs, src.projections, cfg))
        plan = d._jdf.queryExecution().executedPlan()
        text = plan.toString()
        assert "SortMergeJoin" in text
        # exchanges: fact agg (1), installs->projection join (2 sides), latest-per-key (3),
        # sub agg (1); none added for the merge itself
        joins = [line for line in text.splitlines() if "SortMergeJoin" in line and "LeftOuter" in line]
        assert joins
        merge_line = text.splitlines().index(joins[0])
        below = text.splitlines()[merge_line + 1 : merge_line + 4]
        assert not any("Exchange" in line for line in below), "\n".join(below)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_result_independent_of_partitioning(spark):
    cfg = fixtures.fixture_config()
    src = fixtures.load(spark, SMOKE_DIR)
    base = sorted(tuple(map(str, r)) for r in build(src, cfg, Scratch(spark)).channel.collect())
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        src2 = fixtures.Sources(
            fact=src.fact.repartition(5), installs=src.installs.repartition(2),
            projections=src.projections.repartition(7), skan=src.skan.repartition(1),
        )
        other = sorted(tuple(map(str, r)) for r in build(src2, cfg, Scratch(spark)).channel.collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert base == other


def _tree(df) -> list[str]:
    """Operator lines of the formatted physical plan (the tree part only)."""
    text = _plan(df)
    body = text.split("\n\n", 1)[0]
    return [line for line in body.splitlines() if line.strip()]


def test_plan_shape_at_scale(spark):
    """With broadcasts disabled (the shape a large run gets), the campaign details need 6
    exchanges, 2 sort-merge joins and one scan of the projection history, and everything
    downstream of the written details and precedence join needs 2 exchanges and no join."""
    from spendlens.operators.merge import merge_details
    from spendlens.operators.rollup import install_ltv_rollup

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        cfg = fixtures.fixture_config()
        src = fixtures.load(spark, SMOKE_DIR)
        details = merge_details(
            campaign_rollup(src.fact, cfg), install_ltv_rollup(src.installs, src.projections, cfg)
        )
        tree = _tree(details)
        assert sum("Exchange" in line for line in tree) == 6, "\n".join(tree)
        assert sum("SortMergeJoin" in line for line in tree) == 2
        assert _plan(details).count("/projections]") == 1
        downstream = _tree(build(src, cfg, Scratch(spark)).channel)
        assert sum("Exchange" in line for line in downstream) == 2, "\n".join(downstream)
        assert not any("Join" in line for line in downstream)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_bucketed_inputs_need_no_exchange_of_users(spark):
    """On inputs bucketed on the user key the campaign details need 3 exchanges fewer than 6, the history none,
    and the roll-up is the same."""
    from spendlens.operators.merge import merge_details
    from spendlens.operators.rollup import install_ltv_rollup
    from spendlens.sources.bucketed import bucketed_sources

    cfg, src = fixtures.fixture_config(), fixtures.load(spark, SMOKE_DIR)
    root = tempfile.mkdtemp(prefix="spendlens-buckets-")
    own = bucketed_sources(src, "plan_installs", "plan_projections", buckets=4, location=root)
    same = [install_ltv_rollup(s.installs, s.projections, cfg) for s in (src, own)]
    assert sorted(map(str, same[0].collect())) == sorted(map(str, same[1].collect()))
    assert own.installs.count() <= src.installs.count()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        users = install_ltv_rollup(own.installs, own.projections, cfg)
        assert sum("Exchange" in line for line in _tree(users)) == 1, "\n".join(_tree(users))
        details = merge_details(campaign_rollup(own.fact, cfg), users)
        assert sum("Exchange" in line for line in _tree(details)) == 2, "\n".join(_tree(details))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for t in ("plan_installs", "plan_projections"):
            spark.sql(f"DROP TABLE {t}")


def test_run_with_cards_rules_and_a_joint_publication(spark):
    from spendlens.functions.cards import configured_cards
    from spendlens.operators.publication import job_publication
    from spendlens.operators.quality import DEFAULT_RULES, GateRule

    cfg, src = fixtures.fixture_config(), fixtures.load(spark, SMOKE_DIR)
    root = tempfile.mkdtemp(prefix="spendlens-run-joint-")
    joint = job_publication(spark, root, "run_joint_campaign", "run_joint_channel")
    shared = shared_folder(spark)
    before = listing(spark, shared)
    report = run(spark, src, cfg, cards=configured_cards(spark, cfg), publication=joint)
    assert report.commit.version == 1 and spark.table("run_joint_campaign").count() == report.commit.rows["campaign"] > 0
    src.previous = spark.table("run_joint_campaign")
    # a gate that fails publishes nothing
    strict = (*DEFAULT_RULES, GateRule("MUST_GROW", "TOTAL_INSTALL", "not_below"), GateRule("NO_SPEND", "TOTAL_SPEND", "not_above"))
    smaller = fixtures.Sources(fact=src.fact.where("CALENDAR_DT < '1997-01-01'"), installs=src.installs, projections=src.projections, skan=src.skan, previous=src.previous)
    with pytest.raises(QualityGateError):
        run(spark, smaller, cfg, rules=strict, publication=joint)
    assert joint.current().version == 1
    assert run(spark, src, cfg.with_window(cfg.window.shifted(1)), publication=joint).commit.version == 2
    src.previous = None
    # rejects need a folder, and have one
    with pytest.raises(ValueError, match="reject"):
        run(spark, src, cfg, policy="reject")
    report = run(spark, src, cfg, policy="reject", rejects=f"{root}/rejects", publication=joint)
    assert report.rejected == {"campaign": 0, "channel": 0} and report.commit.version == 3
    with pytest.raises(ValueError, match="whole tables"):
        run(spark, src, cfg, publication=joint, only=("SMALL",))
    # the gate's violations stay where its message says; all else of a run is gone
    left = {p.rsplit("/", 1)[-1] for p in listing(spark, shared) - before}
    assert len(left) == 1
    for v in ("run_joint_campaign", "run_joint_channel"):
        spark.sql(f"DROP VIEW {v}")


def test_install_predicates(spark):
    from dataclasses import replace

    from spendlens.operators.rollup import install_ltv_rollup

    cfg, src = fixtures.fixture_config(), fixtures.load(spark, SMOKE_DIR)
    by = lambda df: sorted(map(str, df.collect()))
    pattern = replace(cfg, install_excluded_channel_pattern="%UNTRUSTED%")
    trusted = src.installs.where("CHANNEL_NAME NOT LIKE '%UNTRUSTED%'")
    assert by(install_ltv_rollup(src.installs, src.projections, pattern)) == by(install_ltv_rollup(trusted, src.projections, cfg))
    assert trusted.count() < src.installs.count()
    typed = src.installs.withColumn("mvp_campaign_type", F.when(F.col("USER_ID") % 2 == 0, "New Installs"))
    of_type = replace(cfg, install_campaign_type="New Installs")
    expected = install_ltv_rollup(src.installs.where("USER_ID % 2 = 0"), src.projections, cfg)
    assert by(install_ltv_rollup(typed, src.projections, of_type)) == by(expected)
    with pytest.raises(ValueError, match="MVP_CAMPAIGN_TYPE"):
        install_ltv_rollup(src.installs, src.projections, of_type)


def test_literal_shape_of_the_bench_is_the_same_result(spark):
    import bench
    from spendlens.plans.queries import q07_campaign_details

    cfg, src = fixtures.fixture_config(), fixtures.load(spark, SMOKE_DIR)
    ours = q07_campaign_details(spark, SMOKE_DIR)
    literal = bench.literal_details(spark, src, cfg)
    columns = [f"CAST({c} AS DOUBLE)" if c in C.METRICS_RAW else c for c in sorted(ours.columns)]
    assert sorted(ours.columns) == sorted(literal.columns)
    assert sorted(map(str, ours.selectExpr(*columns).collect())) == sorted(map(str, literal.selectExpr(*columns).collect()))


def test_staged_inputs_are_one_and_can_be_released(spark):
    own = spark.newSession()
    a, b = (fixtures.load(own, SMOKE_DIR) for _ in range(2))
    assert a is b and a is not fixtures.load(spark, SMOKE_DIR)
    place = a.fact.inputFiles()[0].rsplit("/fact/", 1)[0]
    assert listing(spark, place)
    fixtures.release(own)
    assert not listing(spark, place) and fixtures.load(own, SMOKE_DIR) is not a
    fixtures.release(own)
