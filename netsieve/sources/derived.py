"""Log, flow and event tables derived from the shared test tables.

Each text is plain SQL that Spark and DuckDB both run; ``{T3164}`` and ``{T5424}``
stand for the engine's own time formatting.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REF_YEAR = 2024

SPARK_TIME = {
    "T3164": "date_format(ts, 'MMM dd HH:mm:ss')",
    "T5424": "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSS'Z'\")",
}
DUCKDB_TIME = {
    "T3164": "strftime(ts, '%b %d %H:%M:%S')",
    "T5424": "strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ')",
}

LOG_LINES = """
with b as (
  select event_id, ts, user_id, event_type, value,
    concat('10.0.', cast(user_id % 4 as string), '.', cast(1 + user_id % 250 as string)) as ip_in,
    concat('203.0.113.', cast(1 + user_id % 250 as string)) as ip_out,
    concat('u', cast(user_id as string)) as usr,
    case user_id % 8 when 0 then 'core-rtr-01.lab.example' when 1 then 'PA-FW-02' when 2 then 'jun-mx-01'
      when 3 then 'FGT-03' when 4 then 'CP-04' when 5 then 'srv-05' when 6 then '-' else 'node#06' end as host,
    case event_id % 16 when 0 then 'sshd' when 1 then 'authd' when 2 then 'bgpd' when 3 then 'rpd' when 6 then 'threat'
      when 11 then 'vlanmgr' when 14 then 'fwd' else 'sysd' end as prog
  from events),
m as (
  select *, case event_id % 16
    when 0 then concat('session from ', ip_out, ' accepted for user ''', usr, '''')
    when 1 then concat('Login failed for user ', usr, ' from ', ip_out, ', 4 failed attempts')
    when 2 then concat('bgp neighbor ', ip_in, ' (AS', cast(64500 + user_id as string), ') down')
    when 3 then concat('ospf adjacency lost, area 0.0.0.', cast(user_id % 5 as string), ' peer ', ip_in)
    when 4 then concat('Interface GigabitEthernet0/0/', cast(user_id % 4 as string), ' changed state to down')
    when 5 then concat('scan seen from ', ip_out, ' to ', ip_in, ':3389')
    when 6 then concat('threat found: Worm.Gen', cast(user_id % 9 as string), ', source ', ip_out)
    when 7 then concat('malware blocked: Dropper from ', ip_in)
    when 8 then concat('CPU at ', cast(60 + user_id % 40 as string), ' percent')
    when 9 then concat('Fan tray ', cast(user_id % 6 as string), ' temperature high')
    when 10 then concat('route 10.9.', cast(user_id % 250 as string), '.0/24 nexthop ', ip_in)
    when 11 then concat('vlan ', cast(user_id as string), ' trunk pruned')
    when 12 then 'housekeeping done'
    when 13 then 'config saved by operator'
    when 14 then concat('tcp flow to ', ip_in, ' port 22 reset')
    else concat('udp flood against ', ip_in) end as msg
  from b)
select event_id as line_no, case event_id % 50
  when 7 then concat('<', cast(128 + event_id % 8 as string), '>1 ', {T5424}, ' ', host, ' ', prog, ' 77 - - ', msg)
  when 17 then concat('<', cast(128 + event_id % 8 as string), '>1 2024-01-01T00:00:00+05:30 ', host, ' ', prog, ' - - - ', msg)
  when 23 then concat('<', cast(128 + event_id % 8 as string), '>', msg)
  when 29 then '' when 31 then msg when 41 then '   '
  when 37 then concat('<999>', {T3164}, ' ', host, ' ', prog, ': ', msg)
  when 43 then concat('<99999999999999999999>', {T3164}, ' ', host, ' ', prog, ': ', msg)
  else concat('<', cast(128 + event_id % 8 as string), '>', {T3164}, ' ', host, ' ', prog, '[', cast(1000 + event_id % 30000 as string), ']: ', msg) end as line
from m
"""

FLOWS = """
select l_orderkey * 10 + l_linenumber as flow_id,
  case when l_linenumber = 7 then concat('203.0.113.', cast(1 + l_suppkey % 250 as string)) else concat('192.168.', cast(l_suppkey % 4 as string), '.', cast(1 + l_suppkey % 250 as string)) end as src_ip,
  concat('10.0.', cast(l_partkey % 8 as string), '.', cast(1 + l_partkey % 250 as string)) as dst_ip,
  cast(case when l_orderkey % 3 = 0 then 443 else 1024 + l_orderkey % 60000 end as int) as src_port,
  cast(case l_partkey % 6 when 0 then 22 when 1 then 53 when 2 then 80 when 3 then 443 when 4 then 3389 else 1024 + l_partkey end as int) as dst_port,
  case l_returnflag when 'A' then 'TCP' when 'N' then 'UDP' else 'ICMP' end as protocol,
  case when l_quantity < 2 then cast(0 as double) else l_quantity / 2 end as duration,
  cast(1 + l_partkey % 500 as int) as packets, l_extendedprice as bytes, l_shipdate as ts,
  case when l_linenumber = 7 then 1 else 0 end as true_label
from lineitem
"""

SECURITY_EVENTS = """
select event_id, ts, case event_id % 4 when 0 then 'auth' when 1 then 'daemon' when 2 then 'kern' else 'local0' end as facility,
  case event_type when 'error' then 'crit' when 'signup' then 'warning' when 'purchase' then 'notice' else 'info' end as severity,
  case when user_id % 3 = 0 then concat('192.168.1.', cast(1 + user_id % 250 as string)) else concat('198.51.100.', cast(1 + user_id % 250 as string)) end as source_ip,
  case when event_id % 2 = 0 then concat('192.168.2.', cast(1 + event_id % 250 as string)) else concat('203.0.113.', cast(1 + event_id % 250 as string)) end as destination_ip,
  case event_type when 'error' then 'port_scan' when 'signup' then 'login_failure' when 'purchase' then 'data_transfer' when 'view' then 'file_access' else 'login_success' end as event_type,
  concat(event_type, ' seen for user u', cast(user_id as string)) as message,
  cast(floor(value * 100) as bigint) as byte_count, cast(1 + event_id % 500 as bigint) as packet_count, cast(event_id % 3600 as bigint) as session_duration,
  case when event_type = 'error' then 1 else 0 end as is_anomaly
from events
"""

DEVICE_LOGS = """
select event_id, ts, concat('router-', cast(user_id % 20 as string)) as device,
  case event_type when 'error' then (case when event_id % 4 = 0 then 'CRITICAL' else 'ERROR' end) when 'signup' then 'WARNING' when 'view' then 'DEBUG' else 'INFO' end as level,
  case event_id % 5 when 0 then concat('%LINK-3-DOWN: Interface Gi0/', cast(user_id % 4 as string), ' changed state to down')
    when 1 then concat('BGP peer 10.0.0.', cast(user_id % 250 as string), ' went Idle')
    when 2 then concat('Authentication failed for user u', cast(user_id as string), ' from 203.0.113.9')
    when 3 then concat('High CPU load: ', cast(60 + user_id % 40 as string), '% alert')
    else concat('Configuration saved by u', cast(user_id as string)) end as message,
  case event_id % 5 when 0 then 'interface_down' when 1 then 'bgp_issues' when 2 then 'authentication' when 3 then 'performance' else 'configuration' end as category,
  case when event_type = 'error' then 1 else 0 end as true_label
from events
"""

TEXTS = {"log_lines": LOG_LINES, "flows": FLOWS, "security_events": SECURITY_EVENTS, "device_logs": DEVICE_LOGS}


def sql_text(name: str, times: dict) -> str:
    return TEXTS[name].replace("{T3164}", times["T3164"]).replace("{T5424}", times["T5424"])


def derive(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One derived table over the parquet files of ``sf_dir``; other columns are pruned at the scan."""
    base = "lineitem" if name == "flows" else "events"
    table = spark.read.parquet(f"{sf_dir}/{base}.parquet")
    return spark.sql(sql_text(name, SPARK_TIME).replace(f"from {base}", f"from {{{base}}}"), **{base: table})


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt over as many parts as a shuffle has."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw lines with their place: the line number is the order key of one file."""
    return derive(spark, sf_dir, "log_lines").select(
        "line",
        F.lit("events.log").alias("source_file"),
        F.lit(0).cast("bigint").alias("block_start"),
        F.col("line_no").alias("line_seq"),
    )


def flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, "flows").withColumn("ts", F.col("ts").cast("timestamp"))


def security_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, "security_events").withColumn("ts", F.col("ts").cast("timestamp"))


def device_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, "device_logs").withColumn("ts", F.col("ts").cast("timestamp"))
