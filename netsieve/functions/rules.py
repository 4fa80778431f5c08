"""Device and event classification and the risk score.

The keyword cascades are built as SQL text: one parse in the JVM instead of some
hundred calls from Python, and a CASE that stops at its first hit.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netsieve import fixed_values as V


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def contains_any(text: str, words, patterns=()) -> str:
    """SQL test: the expression ``text`` holds a word, or a pattern behind its guard word."""
    tests = [f"contains({text}, {_quoted(w)})" for w in words]
    tests += [f"(contains({text}, {_quoted(guard)}) and rlike({text}, r{_quoted(p)}))" for guard, p in patterns]
    return "(" + " or ".join(tests) + ")"


def first_label(cases, default: str) -> str:
    """SQL CASE over ordered (test, label) pairs."""
    if not cases:
        return _quoted(default)
    body = " ".join(f"when {test} then {_quoted(label)}" for test, label in cases)
    return f"case {body} else {_quoted(default)} end"


def device_type(host: str, program: str, message: str) -> Column:
    """All three arguments are lower-cased, never-null SQL expressions."""
    cases = [(contains_any(host, words), label) for label, words in V.VENDOR_HOST_MARKS.items()]
    cases += [(contains_any(program, words), label) for label, words in V.DEVICE_PROGRAM_MARKS.items()]
    cases.append((contains_any(message, V.FIREWALL_MESSAGE_MARKS), "firewall"))
    return F.expr(first_label(cases, "unknown"))


def event_category(message: str, program: str) -> Column:
    def auth(text):
        return contains_any(text, V.AUTHENTICATION_WORDS, V.AUTHENTICATION_PATTERNS)

    cases = [
        (f"{auth(message)} or {auth(program)}", "authentication"),
        (contains_any(message, V.SECURITY_WORDS, V.SECURITY_PATTERNS), "security"),
        (contains_any(message, V.NETWORK_WORDS, V.NETWORK_PATTERNS), "network"),
        (contains_any(message, V.SYSTEM_WORDS, V.SYSTEM_PATTERNS), "system"),
    ]
    return F.expr(first_label(cases, "other"))


def event_subcategory(category: str, message: str) -> Column:
    body = ""
    for name, (rules, default) in V.SUBCATEGORIES.items():
        label = first_label([(contains_any(message, words), out) for words, out in rules], default)
        body += f" when {_quoted(name)} then {label}"
    return F.expr(f"case {category}{body} end")


def content_class(message: str) -> Column:
    """Coarse content class of a raw record; ``message`` is a lower-cased SQL expression."""
    cases = [(contains_any(message, words), label) for words, label in V.CONTENT_CLASSES]
    return F.expr(first_label(cases, V.CONTENT_CLASS_DEFAULT))


def classify_messages(df: DataFrame) -> DataFrame:
    """Add device type, category, subcategory and the four exclusive flags."""
    # never null, which keeps the generated code of the many substring tests small
    df = df.withColumns({f"_{c}": F.coalesce(F.lower(c), F.lit("")) for c in ("message", "program", "hostname")})
    df = df.withColumns(
        {
            "device_type": device_type("_hostname", "_program", "_message"),
            "event_category": event_category("_message", "_program"),
        }
    )
    category = F.col("event_category")
    return df.withColumns(
        {
            "event_subcategory": event_subcategory("event_category", "_message"),
            "is_security": category == "security",
            "is_authentication": category == "authentication",
            "is_network_event": category == "network",
            "is_system_event": category == "system",
        }
    ).drop("_message", "_program", "_hostname")


# --- risk score -------------------------------------------------------------


def risk_base(severity: Column) -> Column:
    out = None
    for code, points in V.RISK_BY_SEVERITY.items():
        test = severity == code
        out = F.when(test, points) if out is None else out.when(test, points)
    return out.otherwise(0)


def risk_security(is_security: Column, threat_name: Column) -> Column:
    named = F.when(threat_name.isNotNull(), V.RISK_NAMED_THREAT).otherwise(0)
    return F.when(is_security, F.lit(V.RISK_SECURITY) + named).otherwise(0)


def risk_port(port: Column) -> Column:
    return F.when(port.isin(V.RISK_PORTS), V.RISK_PORT).otherwise(0)


def risk_external(source_ip: Column) -> Column:
    inside = reduce(lambda a, b: a | b, [source_ip.startswith(p) for p in V.RISK_INTERNAL_PREFIXES])
    return F.when(source_ip.isNotNull() & ~inside, V.RISK_EXTERNAL_SOURCE).otherwise(0)


def risk_score() -> Column:
    """Capped sum of the parts.

    The extra points for a failed login inside a security event can never apply,
    because the event flags exclude each other; they are left out.
    """
    total = (
        risk_base(F.col("severity"))
        + risk_security(F.col("is_security"), F.col("threat_name"))
        + risk_port(F.col("destination_port"))
        + risk_external(F.col("source_ip"))
    )
    return F.least(total, F.lit(V.RISK_CAP)).cast("int")
