"""GROK and DISSECT: structured columns from message text.

Both compile a pattern to one Java regular expression and give a column per
named part, by built-in expressions alone. Rows that do not match get nulls.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names of the pattern language with what they match.
PATTERNS = {
    "WORD": r"\b\w+\b",
    "INT": r"[+-]?\d+",
    "POSINT": r"\b[1-9]\d*\b",
    "NONNEGINT": r"\b\d+\b",
    "NUMBER": r"[+-]?(?:\d+(?:\.\d+)?|\.\d+)",
    "BASE16NUM": r"[+-]?(?:0x)?[0-9A-Fa-f]+",
    "NOTSPACE": r"\S+",
    "SPACE": r"\s*",
    "DATA": r".*?",
    "GREEDYDATA": r".*",
    "QUOTEDSTRING": r"\"(?:\\.|[^\\\"])*\"|'(?:\\.|[^\\'])*'",
    "UUID": r"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}",
    "USERNAME": r"[A-Za-z0-9._-]+",
    "USER": r"%{USERNAME}",
    "EMAILADDRESS": r"[A-Za-z0-9._%+-]+@%{HOSTNAME}",
    "HOSTNAME": r"\b[0-9A-Za-z][0-9A-Za-z-]{0,62}(?:\.[0-9A-Za-z][0-9A-Za-z-]{0,62})*\b",
    "IPV4": r"\b(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)\b",
    "IPV6": r"(?:[0-9A-Fa-f]{0,4}:){2,7}(?:[0-9A-Fa-f]{1,4}|%{IPV4})?",
    "IP": r"(?:%{IPV6}|%{IPV4})",
    "IPORHOST": r"(?:%{IP}|%{HOSTNAME})",
    "HOSTPORT": r"%{IPORHOST}:%{POSINT}",
    "UNIXPATH": r"(?:/[^\s/?*]*)+",
    "PATH": r"(?:%{UNIXPATH}|[A-Za-z]:(?:\\[^\\?*]*)+)",
    "URIPATH": r"(?:/[^\s?#]*)+",
    "URIPATHPARAM": r"%{URIPATH}(?:\?[^\s#]*)?",
    "URI": r"[A-Za-z][A-Za-z0-9+.-]*://\S+",
    "YEAR": r"\d\d(?:\d\d)?",
    "MONTHNUM": r"(?:0?[1-9]|1[0-2])",
    "MONTH": r"\b(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]*\b",
    "MONTHDAY": r"(?:0?[1-9]|[12]\d|3[01])",
    "TIME": r"(?:2[0-4]|[01]?\d):[0-5]\d(?::[0-5]?\d(?:[.,]\d+)?)?",
    "TIMESTAMP_ISO8601": r"\d{4}-%{MONTHNUM}-%{MONTHDAY}[T ]%{TIME}(?:Z|[+-]\d\d:?\d\d)?",
    "HTTPDATE": r"%{MONTHDAY}/%{MONTH}/%{YEAR}:%{TIME} [+-]\d{4}",
    "LOGLEVEL": r"(?i:trace|debug|info|notice|warn(?:ing)?|err(?:or)?|crit(?:ical)?|alert|fatal|severe|emerg(?:ency)?)",
}
_PART = re.compile(r"%\{(\w+)(?::([\w.@\[\]-]+))?(?::(\w+))?\}")
_CASTS = {"int": "int", "long": "bigint", "double": "double", "float": "float", "boolean": "boolean", "string": "string"}


def grok_regex(pattern: str, extra: dict[str, str] | None = None) -> tuple[str, list[tuple[str, str]]]:
    """A regular expression and its (field, type) groups in order.

    Parentheses of the pattern's own do not capture; unnamed parts match only.
    """
    known = {**PATTERNS, **(extra or {})}
    fields: list[tuple[str, str]] = []

    def expand(text: str, inside: tuple[str, ...]) -> str:
        out, at = [], 0
        for found in _PART.finditer(text):
            name, field, kind = found.groups()
            if name not in known:
                raise ValueError(f"unknown pattern [{name}]")
            if name in inside:
                raise ValueError(f"pattern [{name}] refers to itself")
            if kind and kind not in _CASTS:
                raise ValueError(f"unknown type [{kind}]")
            out.append(_quiet(text[at : found.start()]))
            if field:
                fields.append((field, kind or "string"))
            out.append(("(" if field else "(?:") + expand(known[name], (*inside, name)) + ")")
            at = found.end()
        return "".join(out) + _quiet(text[at:])

    return expand(pattern, ()), fields


def _quiet(text: str) -> str:
    """Plain groups made non-capturing; escapes and classes stay."""
    return re.sub(r"\\.|\[(?:\\.|[^\]])*\]|\((?!\?)", lambda m: "(?:" if m[0] == "(" else m[0], text)


def _columns(source: Column, regex: str, fields: list[tuple[str, str]]) -> list[tuple[str, Column]]:
    hit = source.rlike(regex)
    groups: dict[str, list[Column]] = {}
    kinds = {}
    for i, (name, kind) in enumerate(fields):
        groups.setdefault(name, []).append(F.regexp_extract(source, regex, i + 1))
        kinds.setdefault(name, kind)
    out = []
    for name, found in groups.items():
        value = F.when(hit, F.concat(*found) if len(found) > 1 else found[0])
        out.append((name, value.try_cast(_CASTS[kinds[name]]) if kinds[name] != "string" else value))
    return out


def grok(df: DataFrame, column: str, pattern: str, extra: dict[str, str] | None = None) -> DataFrame:
    """``df`` with a column per named part of the pattern, found anywhere."""
    regex, fields = grok_regex(pattern, extra)
    return df.withColumns(dict(_columns(F.col(column), "(?s)" + regex, fields)))


def dissect_regex(pattern: str) -> tuple[str, list[tuple[str, str]], dict[str, int]]:
    """Whole-text expression, its groups, and per name how often it appends.

    ``%{name}`` keeps, ``%{}`` and ``%{?name}`` skip, ``%{+name}`` appends, and
    ``%{name->}`` also passes over repeats of the delimiter that follows.
    """
    keys = list(re.finditer(r"%\{([?+]?)([^}]*?)(->)?\}", pattern))
    if not keys:
        raise ValueError("a dissect pattern needs at least one key")
    regex, fields, appended, at = "^" + re.escape(pattern[: keys[0].start()]), [], {}, 0
    for i, key in enumerate(keys):
        mark, name, padded = key.groups()
        at = key.end()
        delimiter = pattern[at : keys[i + 1].start()] if i + 1 < len(keys) else pattern[at:]
        last = i + 1 == len(keys)
        body = ".*" if last and not delimiter else ".*?"
        if name and mark != "?":
            regex += f"({body})"
            fields.append((name, "string"))
            appended[name] = appended.get(name, 0) + (mark == "+")
        else:
            regex += f"(?:{body})"
        text = re.escape(delimiter)
        regex += f"(?:{text})+" if padded and delimiter else text
    return regex + ("$" if keys[-1].end() == len(pattern) else ""), fields, appended


def dissect(df: DataFrame, column: str, pattern: str, append_separator: str = "") -> DataFrame:
    """``df`` with a column per key of a dissect pattern."""
    regex, fields, _ = dissect_regex(pattern)
    source = F.col(column)
    regex = "(?s)" + regex
    groups: dict[str, list[Column]] = {}
    for i, (name, _) in enumerate(fields):
        groups.setdefault(name, []).append(F.regexp_extract(source, regex, i + 1))
    hit = source.rlike(regex)
    return df.withColumns({name: F.when(hit, F.concat_ws(append_separator, *found)) for name, found in groups.items()})
