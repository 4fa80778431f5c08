"""Parsing, rules, extraction, scoring, dedup and filters on hand-written lines."""

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from netsieve.functions import parsing, rules
from netsieve.operators import dedup, filters, profile
from netsieve.operators.ordering import occurrence_number
from netsieve.plans.clean import CleanOptions, clean, parse_table, parsed_rows, rejected
from netsieve.sources import readers, writers
from netsieve.sources.readers import read_log_dir

OPTIONS = CleanOptions(ref_year=2023)


def lines(spark, texts, file="a.log"):
    rows = [(t, file, 0, i) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "line string, source_file string, block_start long, line_seq long")


def parse(spark, *texts):
    return parse_table(lines(spark, texts), OPTIONS).orderBy("line_seq").collect()


def one(spark, message, program="prog", host="h"):
    return clean(lines(spark, [f"<134>Jan 02 03:04:05 {host} {program}[7]: {message}"]), OPTIONS).first()


def utc(*parts):
    return datetime(*parts, tzinfo=timezone.utc).timestamp()


def stamp(row):
    return row["timestamp"].replace(tzinfo=timezone.utc).timestamp() if row["timestamp"] else None


@pytest.fixture(scope="module", autouse=True)
def _utc_clock():
    import os
    import time

    os.environ["TZ"] = "UTC"
    time.tzset()


def test_layouts(spark):
    rows = parse(
        spark,
        "<34>1 2023-05-06T07:08:09.123Z web-1.example.org app 55 ID1 - text",
        "<34>May  6 07:08:09 web_1 app[55]: text",
        "<34>May 6 07:08:09 web-1 app: no pid",
        "<34>just text",
        "no priority",
        "   ",
        "",
        "  <34>trimmed \t",
    )
    assert [r["format"] for r in rows] == [
        "rfc5424", "rfc3164", "rfc3164", "fallback", "invalid", "invalid", "blank", "fallback",
    ]
    assert rows[0]["hostname"] == "WEB-1" and rows[0]["pid"] == 55 and rows[0]["message"] == "- text"
    assert stamp(rows[0]) == pytest.approx(utc(2023, 5, 6, 7, 8, 9, 123000))
    assert rows[1]["hostname"] == "WEB_1" and stamp(rows[1]) == utc(2023, 5, 6, 7, 8, 9)
    assert rows[2]["pid"] == 0 and rows[2]["message"] == "no pid"
    assert rows[3]["hostname"] == "UNKNOWN" and rows[3]["program"] == "unknown"
    assert rows[3]["data_quality_issues"] == ["malformed_syslog_format", "unparseable_timestamp"]
    assert rows[4]["priority"] is None
    assert rows[7]["message"] == "trimmed"


def test_parseable_agrees_with_format(spark):
    texts = ["<1>a", "<>a", "<a>b", "<12", " <3>x", "", "\t", "<999999999999999999999>z", "x<1>y"]
    rows = parse_table(lines(spark, texts), OPTIONS).withColumn("p", parsing.parseable(F.col("line"))).collect()
    for r in rows:
        assert r["p"] == (r["format"] not in ("invalid", "blank"))


def test_priority(spark):
    rows = parse(spark, "<0>a", "<191>a", "<192>a", "<99999999999999999999>a")
    assert [(r["priority"], r["facility"], r["severity"], r["severity_name"]) for r in rows] == [
        (0, 0, 0, "Emergency"), (191, 23, 7, "Debug"), (134, 16, 6, "Info"), (0, 0, 0, None),
    ]
    assert "invalid_priority_range" in rows[2]["data_quality_issues"]
    assert "unparseable_priority" in rows[3]["data_quality_issues"]


@pytest.mark.parametrize(
    "text, want",
    [
        ("Feb 29 01:02:03", (2023, 3, 1, 1, 2, 3)),
        ("feb 28 1:02:03", (2023, 2, 28, 1, 2, 3)),
        ("Feb 30 01:02:03", None),
        ("Jan 32 01:02:03", None),
        ("Jan 0 01:02:03", None),
        ("Jan 1 24:00:00", None),
        ("Jan 1 3:60:00", None),
        ("Jan 1 30:00:00", None),
        ("January 1 01:00:00", None),
        ("Jan\t1 01:00:00", None),
        ("Jan 1 01:0:00", None),
    ],
)
def test_rfc3164_time(spark, text, want):
    row = parse(spark, f"<1>{text} h p: m")[0]
    assert stamp(row) == (utc(*want) if want else None)
    assert ("unparseable_timestamp" in row["data_quality_issues"]) == (want is None)


@pytest.mark.parametrize(
    "text, want",
    [
        ("2024-02-29T23:59:59Z", "2024-02-29T23:59:59.000Z"),
        ("2024-02-29T23:59:59.9876Z", "2024-02-29T23:59:59.987Z"),
        ("2024-02-29T23:59:59,5Z", "2024-02-29T23:59:59.500Z"),
        ("2023-02-29T23:59:59Z", None),
        ("2024-01-01T00:00:00+05:30", None),
        ("2024-01-01T00:00:60Z", None),
        ("-", None),
    ],
)
def test_rfc5424_time(spark, text, want):
    row = parse(spark, f"<1>1 {text} h p - - m")[0]
    assert row["normalized_time"] == want


def test_hostname(spark):
    rows = parse(spark, *[f"<1>1 - {h} p - - m" for h in ("-", "node#06", "Ab.c.d", "###", "straße")])
    assert [r["hostname"] for r in rows] == ["-", "NODE06", "AB", "", "STRAE"]
    assert "missing_hostname" in rows[0]["data_quality_issues"]
    assert "missing_hostname" not in rows[3]["data_quality_issues"]


@pytest.mark.parametrize(
    "host, program, message, want",
    [
        ("pa-fw-1", "x", "y", "paloalto"),
        ("jun-rtr-core", "x", "y", "juniper"),
        ("fgt-1", "x", "y", "fortigate"),
        ("cp-1", "x", "y", "checkpoint"),
        ("dist-1", "x", "y", "cisco"),
        ("n1", "BGPd", "y", "router"),
        ("n1", "myfw", "y", "firewall"),
        ("n1", "vlanmgr", "y", "switch"),
        ("n1", "x", "VPN up", "firewall"),
        ("n1", "x", "y", "unknown"),
    ],
)
def test_device(spark, host, program, message, want):
    assert one(spark, message, program, host)["device_type"] == want


@pytest.mark.parametrize(
    "message, category, sub",
    [
        ("Login accepted", "authentication", "login_success"),
        ("password denied", "authentication", "login_failure"),
        ("user  bob", "authentication", "authentication_event"),
        ("attack seen", "security", "threat_detection"),
        ("RTT probe slow", "security", "reconnaissance"),
        ("malware there", "security", "malware_detection"),
        ("brute-force", "security", "security_event"),
        ("bgp idle", "network", "bgp_event"),
        ("ospf idle", "network", "ospf_event"),
        ("link lost", "network", "interface_event"),
        ("route lost", "network", "routing_event"),
        ("description", "network", "network_event"),
        ("power supply", "network", "network_event"),
        ("cpu high", "system", "resource_monitoring"),
        ("fan slow", "system", "hardware_monitoring"),
        ("config saved", "system", "configuration_event"),
        ("alarm", "system", "system_event"),
        ("hello", "other", "unclassified"),
    ],
)
def test_category(spark, message, category, sub):
    row = one(spark, message)
    assert (row["event_category"], row["event_subcategory"]) == (category, sub)
    flags = [row[c] for c in ("is_security", "is_authentication", "is_network_event", "is_system_event")]
    assert sum(flags) == (category != "other")


def test_program_makes_authentication(spark):
    assert one(spark, "hello", "sshd")["event_category"] == "authentication"


def test_extraction(spark):
    row = one(spark, "from 9.9.9.9 and 10.0.0.1 again 9.9.9.9 and 1.2.3.04 and 1:2:3:4:5:6:7:8 port 22 tcp")
    assert row["ips"] == ["10.0.0.1", "1:2:3:4:5:6:7:8", "9.9.9.9"]
    assert (row["source_ip"], row["destination_ip"]) == ("10.0.0.1", "1:2:3:4:5:6:7:8")
    assert one(spark, "threshold: 381ms (threshold: 100ms)")["destination_port"] == 381
    assert one(spark, "port 70000 port 80")["destination_port"] is None
    assert one(spark, "over Tcp now")["protocol"] == "TCP"
    assert one(spark, "Login failed for user from 9.9.9.9")["username"] == "from"
    assert one(spark, "user 'a b' in")["username"] == "a b"
    assert one(spark, "User: bob")["username"] == "bob"
    assert one(spark, "session request")["interface"] == "request"
    assert one(spark, "Interface Gi0/1 lost")["interface"] == "Gi0/1"
    assert one(spark, "xe-0/0/1 lost")["interface"] == "xe-"
    assert one(spark, 'threat: "Worm.A", x')["threat_name"] == "Worm.A"
    assert one(spark, 'saw "big exploit kit" here')["threat_name"] == "big exploit kit"
    assert one(spark, "bgp neighbor 1.1.1.1 via peer 2.2.2.2")["bgp_peer"] == "2.2.2.2"
    assert one(spark, "bgp neighbor 1.1.1.1 via peer 2.2.2.")["bgp_peer"] == "1.1.1.1"
    assert one(spark, "AS 65001")["as_number"] == 65001
    assert one(spark, "AS0")["as_number"] is None
    assert one(spark, "ospf neighbor 3.3.3.3 area 0.0.0.1")["ospf_area"] == "3.3.3.3"
    assert one(spark, "in area 0.0.0.1")["ospf_area"] == "0.0.0.1"
    assert one(spark, "hello")["source_port"] is None


def test_risk(spark):
    def score(pri, message):
        return clean(lines(spark, [f"<{pri}>Jan 02 03:04:05 h p: {message}"]), OPTIONS).first()["risk_score"]

    assert score(134, "hello") == 5
    assert score(128, "hello") == 50
    assert score(128, "threat: x from 8.8.8.8 port 22") == 100
    assert score(130, "probe from 10.1.1.1") == 70
    assert score(99999999999999999999, "hello") == 50


def test_keep_first_over_files(spark):
    a = lines(spark, ["<1>x", "<1>y"], "b.log")
    b = lines(spark, ["<1>y", "<1>z", "<1>z"], "a.log")
    rows = parsed_rows(a.unionByName(b), OPTIONS)
    kept = dedup.keep_first(rows)
    assert {(r["source_file"], r["message"]) for r in kept.collect()} == {("a.log", "y"), ("a.log", "z"), ("b.log", "x")}
    assert dedup.keep_first(kept).count() == kept.count()
    per_file = {r["source_file"]: (r["parsed"], r["kept"], r["removed"]) for r in profile.duplicates_by_file(rows).collect()}
    assert per_file == {"a.log": (3, 2, 1), "b.log": (2, 1, 1)}


def test_group_limit_before_shuffle(spark):
    plan = dedup.keep_first(parsed_rows(lines(spark, ["<1>x"]), OPTIONS))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 1 and "Partial" in plan


def test_line_order_beyond_one_split(spark, tmp_path):
    n = 20000
    (tmp_path / "a.log").write_text("".join(f"<1>line {i:06d} {'x' * 40}\n" for i in range(n)))
    (tmp_path / "b.log").write_text("<1>tail\r\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        df = readers.read_log_dir(spark, str(tmp_path))
        assert df.rdd.getNumPartitions() > 5
        rows = [r["line"] for r in df.orderBy("source_file", "block_start", "line_seq").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert rows[:-1] == [f"<1>line {i:06d} {'x' * 40}" for i in range(n)] and rows[-1] == "<1>tail"


def test_rejects_and_totals(spark):
    df = lines(spark, ["<1>a", "<1>a", "bad", "", "  "])
    assert sorted(r["line"] for r in rejected(df).collect()) == ["  ", "bad"]
    t = profile.cleaning_totals(parse_table(df, OPTIONS)).first()
    assert t["total_processed"] == 5
    assert t["total_processed"] == t["valid_messages"] + t["invalid_messages"] + t["duplicates_removed"] + t["blank_lines"]


def test_filters(spark):
    df = clean(lines(spark, ["<128>Jan 02 03:04:05 h p: attack", "<134>Jan 05 03:04:05 h p: hello", "<134>nothing"]), OPTIONS)

    def kept(**kw):
        return sorted(r["message"] for r in filters.Criteria(**kw).apply(df).collect())

    assert kept() == ["attack", "hello", "nothing"]
    assert kept(min_risk=50) == ["attack"]
    assert kept(start=datetime(2023, 1, 3)) == ["hello"]
    assert kept(end=datetime(2023, 1, 3)) == ["attack", "nothing"]
    assert kept(hostname_pattern="^UNK") == ["nothing"]
    assert kept(hostname_pattern="(") == []


def test_options_prune(spark):
    row = clean(lines(spark, ["<134>user bob 9.9.9.9"]), CleanOptions(extract=("usernames",), score=False)).first()
    assert row["username"] == "bob" and row["source_ip"] is None and row["risk_score"] is None


def test_content_class(spark):
    df = spark.createDataFrame([("ssh key",), ("rtt 5",), ("vpn",), ("nope",)], "m string")
    got = [r[0] for r in df.select(rules.content_class("m")).collect()]
    assert got == ["Login Events", "Latency Events", "VPN Events", "Other Events"]


def test_equal_file_names_in_two_folders_give_their_own_ids(spark, tmp_path):
    for folder in ("a", "b"):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "x.log").write_text("<34>Oct 11 22:14:15 host su: same\n<34>Oct 11 22:14:15 host su: same\n")
    lines = read_log_dir(spark, f"{tmp_path}/*")
    rows = clean(lines, CleanOptions(ref_year=2024, remove_duplicates=False)).select("id", "source_file").collect()
    assert len(rows) == 4 == len({r["id"] for r in rows}) and {r["source_file"] for r in rows} == {"x.log"}


def test_a_line_that_makes_up_a_third_is_numbered_in_ranges(spark):
    said = ["<34>Oct 11 22:14:15 host su: hot"] * 400 + [f"<34>Oct 11 22:14:15 host su: line {i % 300}" for i in range(800)]
    rows = spark.createDataFrame([(t, "x.log", 0, k) for k, t in enumerate(said)], "line string, source_file string, block_start long, line_seq long")
    numbered = occurrence_number(rows.repartition(6), ["line"], ["line_seq"], "again", buckets=8)
    seen = {}
    for r in sorted(numbered.collect(), key=lambda r: r["line_seq"]):
        seen[r["line"]] = seen.get(r["line"], 0) + 1
        assert r["again"] == seen[r["line"]]
    cleaned = clean(rows, CleanOptions(ref_year=2024, remove_duplicates=False))
    assert cleaned.select("id").distinct().count() == len(said)


def test_outputs_by_file_are_few(spark, tmp_path):
    rows = spark.createDataFrame([("<34>Oct 11 22:14:15 host su: line %d" % i, f"f{i % 3}.log", 0, i) for i in range(300)], "line string, source_file string, block_start long, line_seq long")
    writers.write_by_source_file(clean(rows.repartition(8), CleanOptions(ref_year=2024)), str(tmp_path / "out"))
    assert len(list((tmp_path / "out").glob("source_file=*/*.parquet"))) == 3
