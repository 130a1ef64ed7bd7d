import hashlib

from wardflow.llm.exact_dedup import duplicate_report, exact_dedup

SCHEMA = "doc_id bigint, text string, digest string, _WINNER int"
ROWS = [
    (1, "a", "x", 1), (2, "a", "y", 2), (3, None, "z", 3), (4, "", None, 4), (5, "b", "x", 5),
    (5, "b", "x", 5), (None, "b", "x", 6), (None, "é" * 50_000, "x", 7),
] + [(100 + i, "hot", "h", 0) for i in range(40)]


def digest(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


def expected():
    groups = {}
    for i, text, *_ in ROWS:
        groups.setdefault(digest(text), []).append(i)
    rows = []
    for key, ids in groups.items():
        best = max(ids, key=lambda i: (i is not None, i or 0))
        first = True
        for i in ids:
            rows.append((i, best, len(ids), i == best and first, key))
            first = first and i != best
    return rows


def order(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, v) for v in r))


def test_report_equals_brute_force_with_and_without_frequent_digests(frame):
    df = frame(ROWS, SCHEMA)
    for support in (0.001, 0.3, 0.9):
        got = duplicate_report(df, "doc_id", "text", support).collect()
        assert order(map(tuple, got)) == order(expected())


def test_rows_that_stay_keep_their_columns(frame):
    df = frame(ROWS, SCHEMA)
    kept = exact_dedup(df, "doc_id", "text", 0.3)
    assert kept.columns == df.columns
    rows = [tuple(r) for r in kept.collect()]
    assert len(rows) == 5
    assert {r[0] for r in rows} == {2, 4, 5, None, 139}


def test_empty_table(frame):
    df = frame([], SCHEMA)
    assert duplicate_report(df, "doc_id", "text").count() == 0
    assert exact_dedup(df, "doc_id", "text").count() == 0


def test_no_python_on_the_main_path(spark):
    from tests.conftest import plan_text

    df = spark.range(50).selectExpr("id as doc_id", "cast(id % 3 as string) as text")
    for out in (duplicate_report(df, "doc_id", "text"), exact_dedup(df, "doc_id", "text")):
        assert "Python" not in plan_text(out) and "Arrow" not in plan_text(out)
