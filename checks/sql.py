"""DuckDB statements of the shared stages, as common table expressions.

They restate the rules with regular expressions over whole keyword lists, a
different form from the Spark code, so that agreement means something.
"""

from netsieve.sources.derived import DUCKDB_TIME, sql_text


def with_ctes(ctes: list[tuple[str, str]], body: str) -> str:
    return "with " + ",\n".join(f"{n} as ({q})" for n, q in ctes) + "\n" + body


def derived_cte(name: str) -> tuple[str, str]:
    return (name, sql_text(name, DUCKDB_TIME))


# The three line layouts. The keyword lists below are fixed values too.
R5424 = r"^<(\d+)>(\d+)\s+(\S+)\s+(\S+)\s+(\S+)\s+(\S+)\s+(\S+)\s+(.*)$"
R3164 = r"^<(\d+)>(\w+\s+\d+\s+\d+:\d+:\d+)\s+(\S+)\s+([^:\[]+)(?:\[(\d+)\])?:\s*(.*)$"
RFALL = r"^<(\d+)>(.*)$"

TRIMMED = r"""
select line_no, line, regexp_replace(line, '^\s+|\s+$', '', 'g') as text from log_lines"""

FORMATTED = f"""
select *, case when line = '' then 'blank' when text = '' then 'invalid'
  when regexp_matches(text, '{R5424}') then 'rfc5424'
  when regexp_matches(text, '{R3164}') then 'rfc3164'
  when regexp_matches(text, '{RFALL}') then 'fallback' else 'invalid' end as format
from trimmed"""

FIELDS = f"""
select *, regexp_extract(text, '^<(\\d+)>', 1) as pri,
  case format when 'rfc5424' then regexp_extract(text, '{R5424}', 3)
    when 'rfc3164' then regexp_extract(text, '{R3164}', 2) else '' end as time_text,
  case format when 'rfc5424' then regexp_extract(text, '{R5424}', 4)
    when 'rfc3164' then regexp_extract(text, '{R3164}', 3) else 'unknown' end as host,
  case format when 'rfc5424' then regexp_extract(text, '{R5424}', 5)
    when 'rfc3164' then regexp_extract(text, '{R3164}', 4) else 'unknown' end as program,
  case format when 'rfc5424' then regexp_extract(text, '{R5424}', 6)
    when 'rfc3164' then regexp_extract(text, '{R3164}', 5) else '' end as pid_text,
  case format when 'rfc5424' then regexp_extract(text, '{R5424}', 8)
    when 'rfc3164' then regexp_extract(text, '{R3164}', 6)
    else regexp_extract(text, '{RFALL}', 2) end as message
from formatted where format in ('rfc5424', 'rfc3164', 'fallback')"""

NUMBERED = r"""
select *, try_cast(pri as bigint) as pri_number,
  cast(case when try_cast(pri as bigint) is null then 0 when try_cast(pri as bigint) > 191 then 134
    else try_cast(pri as bigint) end as integer) as priority,
  case format
    when 'rfc5424' then case when regexp_matches(time_text, '^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(\.\d+)?Z$')
      then try_cast(replace(replace(time_text, 'T', ' '), 'Z', '') as timestamp) end
    when 'rfc3164' then try_strptime('2024 ' || regexp_replace(time_text, '\s+', ' ', 'g'), '%Y %b %d %H:%M:%S')
  end as ts,
  cast(case when regexp_matches(pid_text, '^[+-]?\d+$') then coalesce(try_cast(pid_text as bigint), 0) else 0 end as bigint) as pid,
  case when host in ('', '-') then host
    else regexp_replace(upper(split_part(host, '.', 1)), '[^A-Z0-9_-]', '', 'g') end as hostname
from fields"""

PARSED = """
select *, cast(priority // 8 as integer) as facility, cast(priority % 8 as integer) as severity,
  case when pri_number is null then null else list_extract(
    ['Emergency','Alert','Critical','Error','Warning','Notice','Info','Debug'], cast(priority % 8 + 1 as integer)) end as severity_name,
  strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') as normalized_time,
  concat_ws(';', case when format = 'fallback' then 'malformed_syslog_format' end,
    case when pri_number is null then 'unparseable_priority' when pri_number > 191 then 'invalid_priority_range' end,
    case when ts is null then 'unparseable_timestamp' end,
    case when host in ('', '-') then 'missing_hostname' end) as issues
from numbered"""

SURVIVORS = """
select * from parsed qualify row_number() over (
  partition by md5(concat(hostname, '-', program, '-', message, '-', coalesce(severity_name, ''))) order by line_no) = 1"""

CATEGORISED = r"""
select *, case
  when regexp_matches(lower(hostname), 'pa-fw|pa-|paloalto') then 'paloalto'
  when regexp_matches(lower(hostname), 'jun-|mx-|ex-|srx-|qfx-') then 'juniper'
  when regexp_matches(lower(hostname), 'fgt-|fortigate') then 'fortigate'
  when regexp_matches(lower(hostname), 'cp-|checkpoint') then 'checkpoint'
  when regexp_matches(lower(hostname), 'rtr|sw|core|edge|dist|access|wan|mpls') then 'cisco'
  when regexp_matches(lower(program), 'bgp|ospf|rpd|routing') then 'router'
  when regexp_matches(lower(program), 'firewall|threat|security|fw') then 'firewall'
  when regexp_matches(lower(program), 'switch|vlan|spanning') then 'switch'
  when regexp_matches(lower(message), 'globalprotect|vpn') then 'firewall' else 'unknown' end as device_type,
 case
  when regexp_matches(lower(message), 'login|authentication|ssh|telnet|console|user\s+(?:''([^'']+)''|(\S+))|succeeded|failed|accepted|denied|password|certificate|key')
    or regexp_matches(lower(program), 'login|authentication|ssh|telnet|console|user\s+(?:''([^'']+)''|(\S+))|succeeded|failed|accepted|denied|password|certificate|key') then 'authentication'
  when regexp_matches(lower(message), 'attack|threat|malware|virus|trojan|backdoor|intrusion|breach|compromise|exploit|scan|probe|reconnaissance|brute.?force|ddos|dos|flood|amplification|botnet|c2|command.?control|exfiltration') then 'security'
  when regexp_matches(lower(message), 'bgp|ospf|eigrp|isis|rip|interface|link|port|ethernet|route|routing|nexthop|gateway|vlan|trunk|spanning.?tree|stp|up|down|flap|change|transition') then 'network'
  when regexp_matches(lower(message), 'cpu|memory|disk|temperature|fan|utilization|usage|threshold|alarm|power|supply|redundancy|backup|config|configuration|startup|shutdown') then 'system'
  else 'other' end as event_category
from survivors"""

CLASSIFIED = r"""
select *, case event_category
  when 'authentication' then case when regexp_matches(lower(message), 'success|accept') then 'login_success'
    when regexp_matches(lower(message), 'fail|denied') then 'login_failure' else 'authentication_event' end
  when 'security' then case when regexp_matches(lower(message), 'attack|threat') then 'threat_detection'
    when regexp_matches(lower(message), 'scan|probe') then 'reconnaissance'
    when regexp_matches(lower(message), 'malware|virus') then 'malware_detection' else 'security_event' end
  when 'network' then case when contains(lower(message), 'bgp') then 'bgp_event' when contains(lower(message), 'ospf') then 'ospf_event'
    when regexp_matches(lower(message), 'interface|link') then 'interface_event'
    when contains(lower(message), 'route') then 'routing_event' else 'network_event' end
  when 'system' then case when regexp_matches(lower(message), 'cpu|memory') then 'resource_monitoring'
    when regexp_matches(lower(message), 'temperature|fan') then 'hardware_monitoring'
    when contains(lower(message), 'config') then 'configuration_event' else 'system_event' end
  else 'unclassified' end as event_subcategory,
  event_category = 'security' as is_security, event_category = 'authentication' as is_authentication,
  event_category = 'network' as is_network_event, event_category = 'system' as is_system_event
from categorised"""

OCT = "(?:25[0-5]|2[0-4][0-9]|[01]?[0-9][0-9]?)"
IPRE = f"(?:{OCT}\\.){{3}}{OCT}|(?:[0-9a-fA-F]{{1,4}}:){{7}}[0-9a-fA-F]{{1,4}}"
# an octet with a leading zero is not an address; a dotted quad of 0..255 is
GOOD = r"^(?:(?:0|[1-9]\d?|1\d\d|2[0-4]\d|25[0-5])\.){3}(?:0|[1-9]\d?|1\d\d|2[0-4]\d|25[0-5])$"

MATCHED = f"""
select *, list_sort(list_distinct(list_filter(regexp_extract_all(message, '{IPRE}', 0),
    lambda ip: contains(ip, ':') or regexp_matches(ip, '{GOOD}')))) as ips,
  try_cast(regexp_extract(message, '(?:port|:)\\s*(\\d{{1,5}})', 1) as integer) as port_number,
  nullif(regexp_extract(message, '(?i)peer\\s+([0-9.]+)', 1), '') as peer,
  nullif(regexp_extract(message, '(?i)bgp.*neighbor\\s+([0-9.]+)', 1), '') as neighbor
from classified"""

EXTRACTED = f"""
select *, ips[1] as source_ip, ips[2] as destination_ip,
  case when port_number between 1 and 65535 then port_number end as destination_port,
  upper(nullif(regexp_extract(message, '(?i)\\b(tcp|udp|icmp|esp|ah|gre|ospf|bgp|eigrp)\\b', 1), '')) as protocol,
  coalesce(nullif(regexp_extract(message, '(?i)user\\s+(?:''([^'']+)''|(\\S+))', 1), ''),
    nullif(regexp_extract(message, '(?i)user\\s+(?:''([^'']+)''|(\\S+))', 2), ''),
    nullif(regexp_extract(message, '(?i)for\\s+user\\s+(?:''([^'']+)''|(\\S+))', 1), ''),
    nullif(regexp_extract(message, '(?i)User:\\s+(\\S+)', 1), '')) as username,
  coalesce(nullif(regexp_extract(message, '(?i)interface\\s+([a-zA-Z0-9/.-]+)', 1), ''),
    nullif(regexp_extract(message, '(?i)on\\s+([a-zA-Z0-9/.-]+)', 1), ''),
    nullif(regexp_extract(message, '(?i)(GigabitEthernet|TenGigabitEthernet|FastEthernet|Serial|Loopback|Tunnel|Vlan|ethernet|ge-|xe-|et-)\\S*', 1), '')) as interface,
  nullif(trim(coalesce(nullif(regexp_extract(message, '(?i)threat[^:]*:\\s*([^,\\s]+)', 1), ''),
    nullif(regexp_extract(message, '(?i)malware[^:]*:\\s*([^,\\s]+)', 1), ''),
    nullif(regexp_extract(message, '(?i)signature[^:]*:\\s*([^,\\s]+)', 1), ''),
    nullif(regexp_extract(message, '(?i)"([^"]*(?:malware|threat|exploit|trojan)[^"]*)"', 1), '')), '"'''), '') as threat_name,
  coalesce(case when regexp_matches(peer, '{GOOD}') then peer end,
    case when regexp_matches(neighbor, '{GOOD}') then neighbor end) as bgp_peer,
  nullif(try_cast(nullif(regexp_extract(message, '(?i)AS\\s*(\\d+)', 1), '') as bigint), 0) as as_number,
  coalesce(nullif(regexp_extract(message, '(?i)ospf.*neighbor\\s+([0-9.]+)', 1), ''),
    nullif(regexp_extract(message, '(?i)area\\s+([0-9.]+)', 1), '')) as ospf_area
from matched"""

CLEANED = """
select *, substr(md5(concat_ws('|', 'events.log', text)), 1, 16) as id,
  cast(least(100, case severity when 0 then 50 when 1 then 50 when 2 then 40 when 3 then 30 when 4 then 20 when 5 then 10 else 5 end
    + case when is_security then 30 + case when threat_name is not null then 20 else 0 end else 0 end
    + case when destination_port in (22, 23, 1433, 3389, 5900) then 10 else 0 end
    + case when source_ip is not null and not (starts_with(source_ip, '192.168.') or starts_with(source_ip, '10.')
        or starts_with(source_ip, '172.16.')) then 15 else 0 end) as integer) as risk_score
from extracted"""

STAGES = [
    ("trimmed", TRIMMED), ("formatted", FORMATTED), ("fields", FIELDS), ("numbered", NUMBERED),
    ("parsed", PARSED), ("survivors", SURVIVORS), ("categorised", CATEGORISED),
    ("classified", CLASSIFIED), ("matched", MATCHED), ("extracted", EXTRACTED), ("cleaned", CLEANED),
]


def clean_sql(body: str, upto: str = "cleaned") -> str:
    """Prefix ``body`` with the cleaning stages up to the named one."""
    names = [n for n, _ in STAGES]
    return with_ctes([derived_cte("log_lines")] + STAGES[: names.index(upto) + 1], body)


def derived_sql(name: str, body: str, *more: tuple[str, str]) -> str:
    return with_ctes([derived_cte(name), *more], body)
