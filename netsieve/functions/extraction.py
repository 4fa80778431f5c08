"""Field extraction from message text, all native expressions.

Each regular expression sits behind a cheap substring guard where its pattern
needs a fixed word, so most rows never start the regex engine.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netsieve import fixed_values as V
from netsieve.functions.parsing import valid_ipv4


def _first(text: Column, pattern: str, group: int = 1) -> Column:
    """Group of the first match, null without one, with the pattern run once."""
    return F.get(F.regexp_extract_all(text, F.lit("(?d)" + pattern), F.lit(group)), F.lit(0))


def _guarded(lower: Column, words, value: Column) -> Column:
    test = lower.contains(words[0])
    for w in words[1:]:
        test = test & lower.contains(w)
    return F.when(test, value)


def _any(lower: Column, words) -> Column:
    return reduce(lambda a, b: a | b, [lower.contains(w) for w in words])


def ip_matches(text: Column) -> Column:
    """Everything that looks like an address, in text order."""
    return F.regexp_extract_all(text, F.lit(V.IP_TEXT), F.lit(0))


def valid_ips(found: Column) -> Column:
    """Distinct valid addresses, sorted as strings: octets with a leading zero are no addresses."""
    bad = F.regexp_extract_all(F.concat_ws(",", found), F.lit(V.LEADING_ZERO_IP), F.lit(0))
    return F.sort_array(F.array_except(found, bad))


def port_number(text: Column) -> Column:
    return _first(text, V.PORT_TEXT).cast("int")


def in_port_range(port: Column) -> Column:
    return F.when(port.between(1, 65535), port)


def protocol(text: Column) -> Column:
    return F.upper(_first(text, V.PROTOCOL_TEXT))


def username(text: Column, lower: Column) -> Column:
    named = F.regexp_replace(_first(text, V.USER_QUOTED_OR_BARE, 0), V.USER_QUOTED_OR_BARE, "$1$2")
    return _guarded(lower, ["user"], F.coalesce(named, _first(text, V.USER_AFTER_COLON)))


def interface_name(text: Column, lower: Column) -> Column:
    return F.coalesce(
        _guarded(lower, ["interface"], _first(text, V.INTERFACE_NAMED)),
        _guarded(lower, ["on"], _first(text, V.INTERFACE_AFTER_ON)),
        F.when(_any(lower, V.INTERFACE_PREFIX_WORDS), _first(text, V.INTERFACE_PREFIX)),
    )


def threat_match(text: Column, lower: Column) -> Column:
    """Raw match of the first threat pattern that hits, quotes kept."""
    return F.coalesce(
        _guarded(lower, ["threat", ":"], _first(text, V.THREAT_AFTER_THREAT)),
        _guarded(lower, ["malware", ":"], _first(text, V.THREAT_AFTER_MALWARE)),
        _guarded(lower, ["signature", ":"], _first(text, V.THREAT_AFTER_SIGNATURE)),
        _guarded(lower, ['"'], _first(text, V.THREAT_QUOTED)),
    )


def threat_name(match: Column) -> Column:
    bare = F.trim(match, F.lit("\"'"))
    return F.when(bare != "", bare)


def bgp_peer(peer: Column, neighbor: Column) -> Column:
    """The later pattern (peer) wins over the earlier one (neighbour) if it is an address."""
    return F.coalesce(F.when(valid_ipv4(peer), peer), F.when(valid_ipv4(neighbor), neighbor))


def peer_match(text: Column, lower: Column) -> Column:
    return _guarded(lower, ["peer"], _first(text, V.BGP_PEER))


def neighbor_match(text: Column, lower: Column) -> Column:
    return _guarded(lower, ["bgp", "neighbor"], _first(text, V.BGP_NEIGHBOR))


def as_number(text: Column, lower: Column) -> Column:
    return _guarded(lower, ["as"], _first(text, V.AS_NUMBER).try_cast("bigint"))


def ospf_area(text: Column, lower: Column) -> Column:
    return F.coalesce(
        _guarded(lower, ["ospf", "neighbor"], _first(text, V.OSPF_NEIGHBOR)),
        _guarded(lower, ["area"], _first(text, V.OSPF_AREA)),
    )


EXTRACTION_GROUPS = ("ips", "ports", "protocols", "usernames", "interfaces", "threat_names", "bgp_info", "ospf_info")


def extract_fields(df: DataFrame, wanted=EXTRACTION_GROUPS) -> DataFrame:
    """Add the extracted columns; groups left out become typed nulls."""
    text, lower = F.col("message"), F.col("_low")

    def on(group, value, kind="string"):
        return value if group in wanted else F.lit(None).cast(kind)

    # Matches that the next step reads more than once get their own projection, so no
    # pattern runs twice.
    df = df.withColumn("_low", F.lower("message"))
    df = df.withColumns(
        {
            "_found": on("ips", ip_matches(text), "array<string>"),
            "_port": on("ports", port_number(text), "int"),
            "_threat": on("threat_names", threat_match(text, lower)),
            "_peer": on("bgp_info", peer_match(text, lower)),
            "_neighbor": on("bgp_info", neighbor_match(text, lower)),
            "_as": on("bgp_info", as_number(text, lower), "bigint"),
        }
    )
    df = df.withColumn("ips", valid_ips(F.col("_found")))
    return df.withColumns(
        {
            "source_ip": F.get("ips", F.lit(0)),
            "destination_ip": F.get("ips", F.lit(1)),
            "source_port": F.lit(None).cast("int"),
            "destination_port": in_port_range(F.col("_port")),
            "protocol": on("protocols", protocol(text)),
            "username": on("usernames", username(text, lower)),
            "interface": on("interfaces", interface_name(text, lower)),
            "threat_name": threat_name(F.col("_threat")),
            "bgp_peer": bgp_peer(F.col("_peer"), F.col("_neighbor")),
            "as_number": F.nullif(F.col("_as"), F.lit(0).cast("bigint")),
            "ospf_area": on("ospf_info", ospf_area(text, lower)),
        }
    ).drop("_low", "_found", "_port", "_threat", "_peer", "_neighbor", "_as")
