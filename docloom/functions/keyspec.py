"""Key-spec strings: ``;``-separated JSON view keys, each with at most one expanded ``((a-b))`` range.

Specs are text columns, so they can come from a literal or from a table. The functions take column names or
SQL expressions and return SQL expressions, for ``selectExpr`` and ``expr``.
"""

from __future__ import annotations

# Fixed values of the key-spec format.
KEY_SEPARATOR = ";"
RANGE_PATTERN = r"\A(.*)\(\((\d+)-(\d+)\)\)(.*)\z"
UNESCAPED_QUOTE = r'(?<!\\)"'
LAST_UNESCAPED_BRACKET = r"(?s)\A.*(?<!\\)([\[\]])"

RANGE_FIELDS = ("prefix", "low", "width", "suffix", "n")


def split_key_spec(spec: str) -> str:
    """SQL that splits a key spec into ``ARRAY<STRING>``.

    A separator counts only outside double quotes and outside square brackets; a backslash before a quote
    or bracket takes its meaning away. The bracket state is a flag (no nesting). Empty keys in the middle
    stay, an empty last key is dropped, nothing is trimmed.

    The text is cut at every separator first. Whether a piece begins a key follows from the quote parity
    and the last bracket of the earlier pieces, so the fold runs over pieces, not characters; it collects
    the numbers of the pieces that begin a key. One-element arrays bind intermediate values once.
    """
    return f"""
        transform(array(split({spec}, '{KEY_SEPARATOR}')), pieces ->
          transform(array(aggregate(
              pieces,
              named_struct('quoted', false, 'bracket', ']', 'starts', cast(array() AS array<int>), 'i', 1),
              (state, piece) -> named_struct(
                'quoted', state.quoted != (regexp_count(piece, r'{UNESCAPED_QUOTE}') % 2 = 1),
                'bracket', coalesce(
                  nullif(regexp_extract(piece, r'{LAST_UNESCAPED_BRACKET}', 1), ''), state.bracket),
                'starts', if(state.quoted OR state.bracket = '[', state.starts, array_append(state.starts, state.i)),
                'i', state.i + 1),
              state -> zip_with(
                state.starts,
                concat(slice(state.starts, 2, size(state.starts)), array(size(pieces) + 1)),
                (begin, end) -> array_join(slice(pieces, begin, end - begin), '{KEY_SEPARATOR}')))),
            keys -> if(element_at(keys, -1) = '', slice(keys, 1, size(keys) - 1), keys))[0])[0]
        """


def key_range(key: str) -> str:
    """SQL that parses one key into ``struct(prefix, low, high, width, suffix, n)``.

    Only the last range of a key is expanded; an earlier one stays literal. Without a range, ``low`` is
    null and ``n`` is 1. ``width`` is the zero-padding width, 0 when the bounds differ in length.
    ``low > high`` gives ``n = 0``. Bounds must fit an int; larger ones fail the cast.
    """

    def group(i: int) -> str:
        return f"regexp_extract({key}, r'{RANGE_PATTERN}', {i})"

    plain = f"""named_struct('prefix', {key}, 'low', cast(null AS int), 'high', cast(null AS int), 'width', 0,
                            'suffix', '', 'n', 1L)"""
    return f"""
        if(NOT contains({key}, '(('), {plain},
           transform(array(array({group(1)}, {group(2)}, {group(3)}, {group(4)})), g ->
             if(g[1] = '', {plain},
                named_struct('prefix', g[0], 'low', cast(g[1] AS int), 'high', cast(g[2] AS int),
                             'width', if(length(g[1]) = length(g[2]), length(g[2]), 0), 'suffix', g[3],
                             'n', greatest(cast(g[2] AS int) - cast(cast(g[1] AS int) AS bigint) + 1, 0L))))[0])
        """


def range_member(prefix: str, low: str, width: str, suffix: str, offset: str) -> str:
    """SQL for the ``offset``-th key (from 0) of a parsed range, zero-padded when the bounds ask for it."""
    number = f"cast({low} + {offset} AS string)"
    return (
        f"if({low} IS NULL, {prefix}, "
        f"concat({prefix}, repeat('0', greatest({width} - length({number}), 0)), {number}, {suffix}))"
    )
