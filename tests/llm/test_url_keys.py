"""Hosts below entries of one label, and hosts that end with a dot."""

from stationlake.llm import url_lists


def test_entries_of_one_label_and_hosts_with_a_dot(spark):
    entries = spark.sql(
        """SELECT 'l' AS list, 'block' AS verdict, pattern, 'add' AS action, timestamp_ntz'2024-01-01' AS dated
        FROM VALUES ('zip'), ('example.com'), ('plain.org/x'), ('dotted.net.') AS t(pattern)"""
    )
    captures = spark.sql(
        """SELECT *, timestamp_ntz'2024-01-04' AS fetched_at FROM VALUES
        (1, 'http://a.b.zip/x'), (2, 'http://zip'), (3, 'http://www.example.com.:80/y'), (4, 'http://example.com./'),
        (5, 'http://plain.org./x/y'), (6, 'http://zipper/'), (7, 'http://./'), (8, 'http://zip.net/'),
        (9, 'http://www.dotted.net./')
        AS t(page_id, url)"""
    )
    got = {r.page_id: r.decided_by for r in url_lists.judged(captures, entries).collect()}
    assert got == {
        1: "zip", 2: "zip", 3: "example.com", 4: "example.com", 5: "plain.org/x", 6: None, 7: None, 8: None,
        9: "dotted.net.",
    }


def test_a_far_capture_does_not_widen_the_index(spark):
    entries = spark.range(200).selectExpr(
        "'l' AS list", "'block' AS verdict", "concat('h', id, '.org') AS pattern",
        "TIMESTAMP_NTZ '2020-01-01 00:00:00' AS dated", "'add' AS action",
    )
    intervals = url_lists.validity_intervals(entries)
    months = [2020 * 12 + 1, 2024 * 12 + 5, 9999 * 12 + 12]
    assert url_lists.interval_index(intervals, months).count() == 200 * len(months)
    captures = spark.sql(
        """SELECT * FROM VALUES (1, 'http://h1.org/', TIMESTAMP_NTZ '9999-12-31 00:00:00'),
        (2, 'http://h2.org/', TIMESTAMP_NTZ '2019-12-31 00:00:00') AS t(page_id, url, fetched_at)"""
    )
    got = {r.page_id: r.decision for r in url_lists.judged(captures, entries).collect()}
    assert got == {1: "block", 2: "none"}
