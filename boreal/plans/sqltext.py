"""Fragments of SQL that the queries' SQL counterparts share."""

from __future__ import annotations

BLANK = r"[\s\x0b\x1c-\x1f\x85\p{Z}]+"


def clean(x: str) -> str:
    return f"trim(regexp_replace({x}, '{BLANK}', ' ', 'g'))"


def norm(x: str) -> str:
    return f"replace(lower({clean(f'nfc_normalize({x})')}), 'ß', 'ss')"


def words(x: str) -> str:
    return f"list_filter(string_split({clean(x)}, ' '), lambda w: w <> '')"


def unit(x: str) -> str:
    return f"(('0x' || substr(sha256({x}), 1, 8))::bigint / 4294967295.0)"


def lines(x: str) -> str:
    return f"string_split(regexp_replace({x}, '\\r\\n?', chr(10), 'g'), chr(10))"


def has_word(x: str, term: str) -> str:
    pattern = (BLANK).join(t.replace("-", r"\-").replace("'", "''") for t in term.lower().split())
    return f"regexp_matches({x}, '(?:^|[^\\p{{L}}\\p{{N}}_]){pattern}(?:$|[^\\p{{L}}\\p{{N}}_])')"


def quote(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def sentences(x: str) -> str:
    marked = clean(x)
    for c in ".!?":
        marked = f"replace({marked}, '{c} ', '{c}' || chr(1))"
    return f"list_filter(string_split({marked}, chr(1)), lambda s: s <> '')"


def typed(sql: str, columns: dict[str, str]) -> str:
    """The same rows with columns cast to given types."""
    casts = ", ".join(f"cast({c} as {t}) as {c}" for c, t in columns.items())
    return f"select * replace ({casts}) from ({sql})"


EXAMPLES = "(select 'train' as split, * from train union all by name select 'dev' as split, * from dev union all by name select 'test' as split, * from test)"
