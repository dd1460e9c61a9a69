"""M1-M10 on small cases."""

import math


from synthtext.operators import metrics as M


def test_token_diversity_case(spark):
    df = spark.createDataFrame([(["a", "b", "b"],), (["b", "c", "d", "c", "e"],)], "tokens array<string>")
    r = M.token_diversity(df, tokens_col="tokens").first()
    assert (r.unique_tokens, r.total_tokens, r.unique_ratio) == (5, 8, 0.625)
    probs = [3 / 8, 2 / 8, 1 / 8, 1 / 8, 1 / 8]
    assert abs(r.entropy - (-sum(p * math.log2(p) for p in probs))) < 1e-12


def test_token_diversity_empty_group(spark):
    df = spark.createDataFrame([(0, "a b a"), (1, ""), (1, "   ")], "batch_id int, text string")
    rows = {r.batch_id: r for r in M.token_diversity(df, text_col="text", group_cols=["batch_id"]).collect()}
    assert rows[1].total_tokens == 0 and rows[1].unique_ratio == 0.0 and rows[1].entropy == 0.0
    assert rows[0].unique_tokens == 2 and rows[0].total_tokens == 3


def test_throughput_case(spark):
    df = spark.createDataFrame([(630, 4.5, 18), (7, 0.0, 0)], "t long, s double, n long")
    from synthtext.functions.ratios import throughput_columns

    rows = df.select(*throughput_columns("t", "s", "n")).collect()
    assert tuple(rows[0]) == (140.0, 4.0, 35.0, 0.25)
    assert tuple(rows[1]) == (0.0, 0.0, 0.0, 0.0)


def test_run_totals_case(spark):
    df = spark.createDataFrame([(0.5, 12, 3), (1.5, 28, 1), (2.0, 0, 4)], "seconds double, num_tokens long, num_samples long")
    r = M.run_totals(df).first()
    assert (r.total_tokens, r.total_samples, r.total_time) == (40, 8, 4.0)
    assert r.tokens_per_second == 10.0 and r.samples_per_second == 2.0


def test_running_totals_two_level(spark):
    rows = [(run, b, float(b % 7), b, 1) for run in (1, 2) for b in range(0, 300, 3)]
    df = spark.createDataFrame(rows, "run_id int, batch_id long, seconds double, num_tokens long, num_samples long")
    got = {(r.run_id, r.batch_id): r.total_tokens for r in M.running_metrics(df, ["run_id"], "batch_id", block_size=16).collect()}
    for run in (1, 2):
        acc = 0
        for b in range(0, 300, 3):
            acc += b
            assert got[(run, b)] == acc


def test_device_usage_case(spark):
    g = 1024 ** 3
    df = spark.createDataFrame([(0, 3 * g, 12 * g), (1, g // 2, g), (2, 5, 0)], "device int, allocated_bytes long, reserved_bytes long")
    rows = {r.device: r for r in M.device_usage(df).collect()}
    assert (rows[0].allocated_gb, rows[0].reserved_gb, rows[0].utilization) == (3.0, 12.0, 0.25)
    assert (rows[1].allocated_gb, rows[1].reserved_gb, rows[1].utilization) == (0.5, 1.0, 0.5)
    assert rows[2].utilization == 0.0


def test_device_usage_no_rows(spark):
    df = spark.createDataFrame([], "device int, allocated_bytes long, reserved_bytes long")
    assert M.device_usage(df).count() == 0


def test_flatten_metrics(spark):
    df = spark.createDataFrame([("r", 1.0, 2.0)], "run_id string, a double, b double")
    got = {(r.name, r.value) for r in M.flatten_metrics(df, ["run_id"], prefix="throughput").collect()}
    assert got == {("throughput/a", 1.0), ("throughput/b", 2.0)}


def test_generation_report_names(spark):
    df = spark.createDataFrame([(0.5, 12, 3), (1.5, 28, 1)], "seconds double, num_tokens long, num_samples long")
    rep = M.generation_report(M.run_totals(df), 4).first().asDict()
    assert rep["throughput/tokens_per_second"] == 20.0
    assert rep["generation/batch_size"] == 4 and rep["time/total_seconds"] == 2.0
