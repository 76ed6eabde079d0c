"""Attempt resolution and back-off."""


from reportlake.operators.attempts import resolve_attempts, with_retry_delay


def log(spark, seqs, max_retries=4):
    rows = []
    for page, statuses in enumerate(seqs, start=1):
        for a, st in enumerate(statuses):
            rows.append(("r", "m", page, a, st, None, f"body{page}.{a}"))
    df = spark.createDataFrame(rows, "report_key string, module string, page_no int, attempt int, status int, retry_after string, body string")
    return {r.page_no: r for r in resolve_attempts(df, max_retries=max_retries).collect()}


def test_retry_then_ok(spark):
    r = log(spark, [[503, 429, 200]])[1]
    assert (r.attempt, r.status, r.outcome, r.n_attempts, r.body) == (2, 200, "ok", 3, "body1.2")


def test_auth_retried_then_fails(spark):
    assert log(spark, [[401, 401]], max_retries=1)[1].outcome == "auth_failed"
    assert log(spark, [[401, 200]], max_retries=1)[1].outcome == "ok"


def test_other_status_is_final_at_once(spark):
    r = log(spark, [[404, 200]])[1]
    assert (r.attempt, r.outcome) == (0, "gave_up")


def test_retryable_exhausted_gives_up(spark):
    assert log(spark, [[500, 500]], max_retries=1)[1].outcome == "gave_up"


def test_unfinished_request_is_pending(spark):
    assert log(spark, [[503, 503]], max_retries=4)[1].outcome == "pending"


def test_backoff_schedule(spark):
    df = spark.createDataFrame(
        [(0, None), (1, None), (2, "not-a-number"), (0, "7"), (3, " 1.5 "), (1, "")],
        "attempt int, retry_after string",
    )
    got = [r.planned_delay_s for r in with_retry_delay(df, base_delay=1.0).collect()]
    assert got == [1.0, 2.0, 4.0, 7.0, 1.5, 2.0]
    got2 = [r.planned_delay_s for r in with_retry_delay(df.limit(3), base_delay=2.0).collect()]
    assert got2 == [2.0, 4.0, 8.0]


def test_attempt_log_feeds_extraction(spark):
    from conftest import wrap

    from reportlake.operators.attempts import responses_from_attempts
    from reportlake.plans.extract import extract

    def page(v, rt):
        ds = {"ValueDicts": {}, "PH": [{"DM0": [{"S": [{"N": "G0"}], "C": [v]}]}]}
        if rt:
            ds["RT"] = rt
        return wrap(ds, [{"Value": "G0", "Name": "T.Name"}])

    rows = [
        ("r", "m", 1, 0, 503, "2", None), ("r", "m", 1, 1, 200, None, page("a", [[1]])),
        ("r", "m", 2, 0, 200, None, page("b", [[2]])),
        ("r", "m", 3, 0, 429, None, None),  # still pending: the module stops before page 3
        ("r", "n", 1, 0, 401, None, None), ("r", "n", 1, 1, 401, None, None),
    ]
    log = spark.createDataFrame(rows, "report_key string, module string, page_no int, attempt int, status int, retry_after string, body string")
    ex = extract(responses_from_attempts(log, max_retries=1))
    st = {r.module: (r.status, r.n_rows) for r in ex.status().collect()}
    assert st == {"m": ("incomplete", 2), "n": ("failed", 0)}
    assert [r.Name for r in ex.table("r", "m", with_order=True).orderBy("page_no").collect()] == ["a", "b"]
