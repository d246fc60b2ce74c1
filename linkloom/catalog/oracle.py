"""Building blocks of the checking SQL."""

from __future__ import annotations

from linkloom.catalog.inputs import (
    CATEGORYLINKS_SQL,
    DUMPS,
    PAGE_SQL,
    PAGELINKS_SQL,
    THRESHOLD,
    TUPLES_PER_LINE,
    VIEWS_SQL,
)
from linkloom.functions.text import INTERNAL_TITLE

INTERNAL = INTERNAL_TITLE


# The permutation of linkloom.operators.zeros.
STRETCH, ROUNDS, PRIME, MULTIPLIER = 64, 4, (1 << 31) - 1, 1_103_515_245


def crc32(text: str) -> str:
    """CRC-32 of ASCII text, bit by bit."""
    return f"""xor(list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), lambda c: ascii(c)::BIGINT)),
      lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
        lambda bits, step: xor(bits >> 1, CASE WHEN bits & 1 = 1 THEN 3988292384 ELSE 0 END))), 4294967295)"""


def dump_lines(table: str, source: str | None = None, raw: bool = False) -> str:
    """Insert lines of a table as ``(line, value)``; ``source`` may narrow the rows, not the line numbers.

    ``raw`` lines have the blanks of the dump between tuples, which filtered lines lose.
    """
    text, _ = DUMPS[table]
    between = "case when line % 3 = 1 then ' , ' else ',' end" if raw else "','"
    tuples = f"replace(string_agg(tuple, chr(1) order by pos), chr(1), {between})"
    return f"""select line, concat('INSERT INTO `{table}` VALUES ', {tuples}, ';') as value
      from (select line, pos, {text} as tuple from {source or table + '_lines'}) group by line"""


def numbered(table: str) -> str:
    keys = ", ".join(DUMPS[table][1])
    return f"""select *, pos // {TUPLES_PER_LINE} as line
      from (select *, row_number() over (order by {keys}) - 1 as pos from {table})"""


# name -> (needed CTEs, SQL)
_CTES: dict[str, tuple[list[str], str]] = {
    "views": ([], VIEWS_SQL),
    "decoded": (
        ["views"],
        """select f[1] as project, array_to_string(f[2:len(f) - 2], ' ') as page_title,
             f[len(f) - 1]::BIGINT as count, f[len(f)]::BIGINT as last
           from (select string_split(value, ' ') as f from views)""",
    ),
    "counts": (
        ["decoded"],
        f"""select page_title, sum(count)::BIGINT as count from decoded
            where project = 'en' and not regexp_matches(page_title, '{INTERNAL}') group by page_title""",
    ),
    "page": ([], PAGE_SQL),
    "pagelinks": (["page"], PAGELINKS_SQL),
    "categorylinks": (["page"], CATEGORYLINKS_SQL),
    "page_lines": (["page"], numbered("page")),
    "pagelinks_lines": (["pagelinks"], numbered("pagelinks")),
    "categorylinks_lines": (["categorylinks"], numbered("categorylinks")),
    "counted": (
        ["page", "pagelinks"],
        """select page_id, page_title, coalesce(i.n, 0) as inlinks, coalesce(o.n, 0) as outlinks
           from page
           left join (select pl_title, count(*) as n from pagelinks
                      where pl_from_namespace = 0 and pl_namespace = 0 group by 1) i on i.pl_title = page_title
           left join (select pl_from, count(*) as n from pagelinks group by 1) o on o.pl_from = page_id
           where page_is_redirect = 0""",
    ),
    "kept": (["counted"], f"select * from counted where inlinks + outlinks >= {THRESHOLD}"),
    "pages_dict": (
        ["kept"],
        "select row_number() over (order by page_id) - 1 as id, page_title as name, page_id from kept",
    ),
    "cats_dict": (
        ["kept", "categorylinks"],
        """select row_number() over (order by cl_to) - 1 as id, cl_to as name
           from (select distinct cl_to from categorylinks where cl_from in (select page_id from kept))""",
    ),
    "shape": (
        ["pages_dict", "cats_dict"],
        """select (select count(*) from pages_dict) as p,
             2 * (select count(*) from pages_dict) + (select count(*) from cats_dict) as c""",
    ),
    "known": (["page", "pages_dict"], "select page.page_id, page_title, id from page join pages_dict on name = page_title"),
    "cells": (
        ["known", "pagelinks", "categorylinks", "shape", "cats_dict"],
        """select t.id as row, f.id as col, 1.0::FLOAT as value from pagelinks
             join known t on t.page_title = pl_title join known f on f.page_id = pl_from
             where pl_from_namespace = 0 and pl_namespace = 0
           union all
           select f.id, d.id + (select p from shape), 1.0::FLOAT from pagelinks
             join known f on f.page_id = pl_from join pages_dict d on d.name = pl_title
           union all
           select f.id, d.id + 2 * (select p from shape), 1.0::FLOAT from categorylinks
             join known f on f.page_id = cl_from join cats_dict d on d.name = cl_to""",
    ),
    "positives": (["cells"], "select row, col, max(value) as value from cells group by row, col"),
}


def query(body: str, *needs: str) -> str:
    """``body`` with the CTEs it needs."""
    order: list[str] = []

    def add(name: str) -> None:
        for other in _CTES[name][0]:
            add(other)
        if name not in order:
            order.append(name)

    for name in needs:
        add(name)
    ctes = ",\n".join(f"{name} as materialized ({_CTES[name][1]})" for name in order)
    return f"with {ctes}\n{body}" if ctes else body


def _feistel(x: str) -> str:
    """The permutation of pairs below (a, b), round by round."""
    left, right = f"(({x}) % a)", f"(({x}) // a)"

    def mixed(value: str, i: int) -> str:
        t = f"(({value} + keys[{i + 1}]) % {PRIME})"
        return f"((({t} * {t}) % {PRIME} * {MULTIPLIER}) % {PRIME})"

    for i in range(ROUNDS):
        if i % 2 == 0:
            left = f"(({left} + {mixed(right, i)}) % a)"
        else:
            right = f"(({right} + {mixed(left, i)}) % b)"
    return f"({left} + {right} * a)"


def zeros(blocks: int, factor: float, seed: int) -> str:
    """Zero cells by rank: in each stretch between positives its share, by a permutation of its free cells.

    The cell of a rank is found by counting, for every drawn rank, the positives which have as many free cells before them.
    """
    keys = ", ".join(f"concat('0x', substr(digest, {1 + 7 * i}, 7))::BIGINT" for i in range(ROUNDS))
    return f"""select * from (with limits as (
      select b as block, size, c, greatest(0, least(size, p - b * size)) * c as cells,
             floor((select count(*) from cells)::DOUBLE / p * greatest(0, least(size, p - b * size)) * {factor})::BIGINT as wanted
      from (select p, c, (p - 1) // {blocks} + 1 as size from shape), range(0, {blocks}) r(b)
    ), placed as (
      select block, place, row_number() over (partition by block order by place) - 1 as j
      from (select row // size as block, (row - row // size * size) * c + col as place from positives, (select any_value(size) as size, any_value(c) as c from limits))
    ), heads as (
      select block, j // {STRETCH} as stretch, min(place) as head, count(*) as n from placed group by all
      union all select block, 0, 0, 0 from limits where block not in (select block from placed)
    ), stretches as (
      select h.block, stretch, case when stretch = 0 then 0 else head end as low,
             coalesce(lead(head) over (partition by h.block order by stretch), cells) - (case when stretch = 0 then 0 else head end) - n as free,
             cells - (select count(*) from placed q where q.block = h.block) as block_free, wanted, size, c,
             md5(concat_ws(':', '{seed}', h.block::VARCHAR, stretch::VARCHAR)) as digest
      from heads h join limits using (block)
    ), shares as (
      select *, floor(sqrt(free::DOUBLE))::BIGINT + 1 as a, [{keys}] as keys,
             ((low - stretch * {STRETCH} + free)::HUGEINT * wanted // block_free - (low - stretch * {STRETCH})::HUGEINT * wanted // block_free)::BIGINT as n
      from stretches where wanted > 0
    ), once as (
      select *, {_feistel('number')} as first
      from (select *, (free + a - 1) // a as b, unnest(range(0, n)) as number from shares)
    ), ranked as (
      select *, case when first < free then first else list_reduce(list_prepend(first, range(0, a * b - free)),
                lambda x, step: case when x < free then x else {_feistel('x')} end) end as rank
      from once
    )
    select r.block, r.block * size + cell // c as row, cell % c as col
    from (select ranked.block, size, c, low + rank + count(place) as cell
          from ranked left join placed on placed.block = ranked.block and placed.j // {STRETCH} = stretch
            and place - low - (placed.j - stretch * {STRETCH}) <= rank
          group by ranked.block, stretch, size, c, low, rank) r)"""
