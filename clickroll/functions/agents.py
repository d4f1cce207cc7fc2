"""What a browser agent string says, by patterns.

Meant to run once per distinct unknown agent, never per click.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns in order of precedence; the first that matches names the agent.
BROWSERS = [
    ("Googlebot", r"Googlebot/([0-9.]+)", "ROBOT"),
    ("bingbot", r"bingbot/([0-9.]+)", "ROBOT"),
    ("UC Browser", r"UCBrowser/([0-9.]+)", "MOBILE_BROWSER"),
    ("Opera Mini", r"Opera Mini/([0-9.]+)", "MOBILE_BROWSER"),
    ("Edge", r"Edge?/([0-9.]+)", "BROWSER"),
    ("Opera", r"OPR/([0-9.]+)", "BROWSER"),
    ("Chrome Mobile", r"Chrome/([0-9.]+) Mobile", "MOBILE_BROWSER"),
    ("Chrome", r"Chrome/([0-9.]+)", "BROWSER"),
    ("Firefox", r"Firefox/([0-9.]+)", "BROWSER"),
    ("IE", r"MSIE ([0-9.]+)", "BROWSER"),
    ("Mobile Safari", r"Version/([0-9.]+) Mobile", "MOBILE_BROWSER"),
    ("Safari", r"Version/([0-9.]+) Safari", "BROWSER"),
]

SYSTEMS = [
    ("Windows 10", "Windows NT 10", "Windows"),
    ("Windows 7", "Windows NT 6.1", "Windows"),
    ("Windows", "Windows", "Windows"),
    ("Android", "Android", "Android"),
    ("iOS", "iPhone OS|CPU OS", "iOS"),
    ("OS X", "Mac OS X", "OS X"),
    ("Linux", "Linux", "Linux"),
]

DEVICES = [
    ("Other", "Googlebot|bingbot"),
    ("Tablet", "iPad|Tablet"),
    ("Smartphone", "iPhone|Android.* Mobile|Opera Mini|UCBrowser"),
    ("Tablet", "Android"),
    ("Personal computer", "Windows|Mac OS X|Linux"),
]

UNKNOWN = "unknown"


def _first_match(text: Column, rules: list[tuple[str, str]], value) -> Column:
    name = None
    for label, pattern in rules:
        hit = text.rlike(pattern)
        name = F.when(hit, value(label, pattern)) if name is None else name.when(
            hit, value(label, pattern)
        )
    return name.otherwise(F.lit(UNKNOWN))


def describe_agent(agent: Column | str) -> dict[str, Column]:
    """Browser name, version and type, device category, system name and family."""
    text = F.coalesce(F.col(agent) if isinstance(agent, str) else agent, F.lit(""))
    by_name = [(name, pattern) for name, pattern, _ in BROWSERS]
    by_type = [(kind, pattern) for _, pattern, kind in BROWSERS]
    literal = lambda label, _: F.lit(label)
    return {
        "browser_name": _first_match(text, by_name, literal),
        "browser_version": _first_match(
            text, by_name, lambda _, pattern: F.regexp_extract(text, pattern, 1)
        ),
        "browser_type": _first_match(text, by_type, literal),
        "device_category": _first_match(text, DEVICES, literal),
        "os_name": _first_match(text, [(n, p) for n, p, _ in SYSTEMS], literal),
        "os_family": _first_match(text, [(f, p) for _, p, f in SYSTEMS], literal),
    }
