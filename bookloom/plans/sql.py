"""Pieces of SQL that several queries share."""

from __future__ import annotations

from bookloom.functions import keys as K


def squeezed_sql(c: str) -> str:
    """Null as empty, white space as single spaces, trimmed."""
    return f"trim(regexp_replace(coalesce({c}, ''), '{K.SPACE}+', ' ', 'g'))"


def key_sql(c: str) -> str:
    """Lower-case letters a to z and digits, all else single spaces."""
    return f"trim(regexp_replace(replace(lower(strip_accents({squeezed_sql(c)})), '&', ' and '), '[^a-z0-9]+', ' ', 'g'))"


def contributor_steps(name: str, source: str, author: str = "author") -> str:
    """Steps of a WITH clause; the last, ``name`` and 3, adds ``nameKeys``, the key of each contributor in order, to the rows of ``source``."""
    text = squeezed_sql(author)
    for mark in (K.EDITOR, K.EDITOR_END, K.OTHERS):
        text = f"regexp_replace({text}, '{mark}', ' ', 'g')"
    pieces = lambda p: f"list_filter(list_transform(string_split({p}, ','), lambda x: {squeezed_sql('x')}), lambda x: x <> '')"
    words = lambda p: f"len(string_split({p}, ' '))"
    listed = f"len({pieces('p')}) > 2 OR (len({pieces('p')}) = 2 AND joined AND NOT ({words(pieces('p') + '[1]')} = 1 AND {words(pieces('p') + '[2]')} <= 2))"
    turned = f"CASE WHEN len({pieces('n')}) = 2 AND {words(pieces('n') + '[1]')} <= 3 THEN {pieces('n')}[2] || ' ' || {pieces('n')}[1] ELSE n END"
    return f"""{name}1 AS (SELECT *, {squeezed_sql(text)} AS byline FROM {source}), {name}2 AS (SELECT *, regexp_matches(byline, '{K.CONJUNCTION}') AS joined FROM {name}1),
{name}3 AS (SELECT *, list_transform(list_filter(flatten(list_transform(regexp_split_to_array(byline, '{K.CONJUNCTION}'), lambda p: CASE WHEN {listed} THEN {pieces('p')} ELSE [{squeezed_sql('p')}] END)), lambda n: n <> ''), lambda n: {key_sql(turned)}) AS nameKeys FROM {name}2)"""
