"""Gauges in nested tables addressed by row id, in column expressions only.

Some device pages put every gauge at
``//tr[@id=k]/td[2]/table/tbody/tr/td/table/tbody/tr/td[2]`` (first match:
toner, second match: imaging unit). A page is cut at its table tags by one
pattern, and a fold over these keeps the open table elements as a stack, with
a path state for each: a bit per (step of the path, row id). A child's state
is its parent's, shifted by one step and masked by what the child is, so any
nesting costs one pass and no recursion.

Markup is read as a browser reads tables: a cell, row or section that begins
closes what it cannot stand in, back to the nearest table; a row directly in
a table stands in an implied ``tbody``, a cell directly in a table or a section in an
implied row; end tags without their element are ignored, as are table
elements outside any table. Other tags do not matter to the path; their text does.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from supplyscope.functions.scalars import strip_ws

# Comments and elements whose text is no markup.
_UNREAD = r"(?is)<!--.*?-->|<(script|style|textarea|title)\b.*?</\1\s*>"
# A tag of a table element, attributes quoted or not.
_TAG = r"""(?i)</?(?:table|tbody|thead|tfoot|tr|td|th)(?=[\s/>])(?:[^>"']++|"[^"]*+"|'[^']*+')*+>"""
_ID = r"""(?i)\sid\s*=\s*["']?\s*([^\s"'>]+)"""
TABLE, BODY, SECTION, ROW, CELL, HEAD = 1, 2, 3, 4, 5, 6
_CODE = {"table": TABLE, "tbody": BODY, "thead": SECTION, "tfoot": SECTION, "tr": ROW, "td": CELL, "th": HEAD}
_ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#37;", "%"), ("&percnt;", "%"), ("&amp;", "&"))


def once(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _tokens(html: Column, ids: int) -> Column:
    """Array of ``(kind, close, id, text)``: a table tag, the bit of its row id, and the markup up to the next one."""
    def token(t: Column, text: Column) -> Column:
        def named(name: Column) -> Column:
            kind = F.lit(0)
            for tag, code in _CODE.items():
                kind = F.when(name == tag, code).otherwise(kind)
            row = F.lit(0).cast("long")
            for k in range(ids):
                row = F.when(F.regexp_extract(t, _ID, 1) == str(k + 1), F.lit(1 << (ids + k)).cast("long")).otherwise(row)
            return F.struct(kind.cast("int").alias("kind"), F.startswith(t, F.lit("</")).alias("close"),
                            F.when((name == "tr") & F.contains(t, F.lit("=")), row).otherwise(0).cast("long").alias("id"),
                            text.alias("text"))

        return once(F.lower(F.regexp_extract(t, r"^</?(\w+)", 1)), named)

    def cut(clean: Column) -> Column:
        texts = F.split(clean, _TAG)
        return F.zip_with(F.regexp_extract_all(clean, F.lit(_TAG), F.lit(0)), F.slice(texts, 2, F.size(texts)), token)

    return once(F.regexp_replace(html, _UNREAD, ""), cut)


class _Fold:
    """The step of the fold, for ``rows`` row ids with ``matches`` cells each."""

    def __init__(self, rows: int, matches: int):
        self.rows, self.matches = rows, matches

    def at(self, *steps: int) -> Column:
        """Bits of these steps of the path: 1 the row with an id, 2 its second cell, 3 table, 4 tbody,
        5 row, 6 cell, 7 table, 8 tbody, 9 row, 10 second cell."""
        return F.lit(sum(((1 << self.rows) - 1) << (s * self.rows) for s in steps))

    def next(self, mask: Column, steps: int = 1) -> Column:
        return F.shiftleft(F.coalesce(mask, F.lit(0).cast("long")), self.rows * steps)

    @staticmethod
    def entry(kind, mask: Column, cells, caps: Column, base: Column) -> Column:
        lit = lambda x: x if isinstance(x, Column) else F.lit(x)
        return F.struct(lit(kind).cast("int").alias("t"), mask.cast("long").alias("m"), lit(cells).cast("int").alias("n"),
                        F.coalesce(caps, F.lit(0)).cast("int").alias("c"), base.cast("int").alias("b"))

    def row_mask(self, parent: Column) -> Column:
        """A row stands in a tbody or, implied, in a table."""
        return (self.next(parent["m"]).bitwiseOR(self.next(parent["m"], 2))).bitwiseAND(self.at(5, 9))

    def begin(self, stack: Column, top: Column, x: Column) -> Column:
        base = F.coalesce(top["b"], F.lit(0))
        one, two = F.get(stack, base), F.get(stack, base + 1)          # what stands right above the nearest table
        section = one["t"].isin(BODY, SECTION)
        row = F.when(one["t"] == ROW, base + 1).when(section & (two["t"] == ROW), base + 2).otherwise(0)

        def table() -> Column:
            outer = F.when((base > 0) & ~top["t"].isin(CELL, HEAD), F.slice(stack, 1, F.greatest(base - 1, F.lit(0)))).otherwise(stack)
            return once(outer, lambda kept: once(F.get(kept, F.size(kept) - 1), lambda p: F.concat(kept, F.array(self.entry(
                TABLE, self.next(p["m"]).bitwiseAND(self.at(3, 7)), 0, p["c"], F.size(kept) + 1)))))

        def part(kind: int) -> Column:
            p = F.get(stack, base - 1)
            mask = self.next(p["m"]).bitwiseAND(self.at(4, 8)) if kind == BODY else F.lit(0)
            return F.concat(F.slice(stack, 1, base), F.array(self.entry(kind, mask, 0, p["c"], base)))

        def line() -> Column:
            return once(F.slice(stack, 1, F.when(section, base + 1).otherwise(base)), lambda kept: once(
                F.get(kept, F.size(kept) - 1), lambda p: F.concat(kept, F.array(self.entry(
                    ROW, self.row_mask(p).bitwiseOR(x["id"]), 0, p["c"], base)))))

        def cell(kind: int) -> Column:
            up = F.get(stack, F.when(section, base).otherwise(base - 1))      # parent of an implied row
            implied = self.entry(ROW, self.row_mask(up), 0, up["c"], base)
            below = F.when(row > 0, F.slice(stack, 1, F.greatest(row - 1, F.lit(0)))).otherwise(
                F.slice(stack, 1, F.when(section, base + 1).otherwise(base)))

            def put(tr: Column) -> Column:
                n = tr["n"] + (1 if kind == CELL else 0)
                steps = F.when(n == 2, self.at(2, 6, 10)).otherwise(self.at(6)) if kind == CELL else F.lit(0)
                return F.concat(below, F.array(self.entry(ROW, tr["m"], n, tr["c"], tr["b"]),
                                               self.entry(kind, self.next(tr["m"]).bitwiseAND(steps), 0, tr["c"], base)))

            return once(F.when(row > 0, F.get(stack, row - 1)).otherwise(implied), put)

        k, inside = x["kind"], base > 0
        return (F.when(k == TABLE, table()).when(inside & (k == BODY), part(BODY)).when(inside & (k == SECTION), part(SECTION))
                .when(inside & (k == ROW), line()).when(inside & (k == CELL), cell(CELL)).when(inside & (k == HEAD), cell(HEAD))
                .otherwise(stack))

    def end(self, stack: Column, top: Column, x: Column) -> Column:
        """What an end tag closes lies above the nearest table (or is that table)."""
        base, k = F.coalesce(top["b"], F.lit(0)), x["kind"]
        one, two = F.get(stack, base), F.get(stack, base + 1)
        section = one["t"].isin(BODY, SECTION)
        row = F.when(one["t"] == ROW, base + 1).when(section & (two["t"] == ROW), base + 2).otherwise(0)
        keep = (F.when(k == TABLE, base - 1).when(k.isin(BODY, SECTION) & (one["t"] == k), base)
                .when((k == ROW) & (row > 0), row - 1)
                .when(k.isin(CELL, HEAD) & (row > 0) & (F.get(stack, row)["t"] == k), row))
        return F.when((base > 0) & keep.isNotNull(), F.slice(stack, 1, F.greatest(keep, F.lit(0)))).otherwise(stack)

    def opened(self, s: Column) -> Column:
        """Give a cell at the end of the path its places among the results: the first free ones of its row ids."""
        def claim(top: Column) -> Column:
            free = []
            for i in range(self.rows * self.matches):
                k, m = divmod(i, self.matches)
                bit = top["m"].bitwiseAND(F.lit(1 << (10 * self.rows + k))) != 0
                taken = F.get(s["out"], F.lit(i - 1)).isNotNull() if m else F.lit(True)
                free.append(F.coalesce(bit & F.get(s["out"], F.lit(i)).isNull() & taken, F.lit(False)))
            caps = top["c"]
            for i, f in enumerate(free):
                caps = caps.bitwiseOR(F.when(f, 1 << i).otherwise(0))
            out = F.array(*[F.when(f, "").otherwise(F.get(s["out"], F.lit(i))) for i, f in enumerate(free)])
            stack = F.concat(F.slice(s["stack"], 1, F.size(s["stack"]) - 1),
                             F.array(self.entry(top["t"], top["m"], top["n"], caps, top["b"])))
            return F.struct(stack.alias("stack"), out.alias("out"))

        last = F.get(s["stack"], F.size(s["stack"]) - 1)
        return F.when(F.coalesce(last["m"].bitwiseAND(self.at(10)) != 0, F.lit(False)), once(last, claim)).otherwise(s)

    def step(self, s: Column, x: Column) -> Column:
        same = lambda stack: F.struct(stack.alias("stack"), s["out"].alias("out"))

        def moved(top: Column) -> Column:
            begun = same(self.begin(s["stack"], top, x))
            begun = F.when(x["kind"] == CELL, once(begun, self.opened)).otherwise(begun)
            return F.when(x["close"], same(self.end(s["stack"], top, x))).otherwise(begun)

        def read(now: Column) -> Column:
            caps = F.coalesce(F.get(now["stack"], F.size(now["stack"]) - 1)["c"], F.lit(0))
            out = F.transform(now["out"], lambda v, i: F.when(
                F.call_function("shiftright", caps, i).bitwiseAND(F.lit(1)) != 0, F.concat(v, x["text"])).otherwise(v))
            return F.when(caps != 0, F.struct(now["stack"].alias("stack"), out.alias("out"))).otherwise(now)

        return once(once(F.get(s["stack"], F.size(s["stack"]) - 1), moved), read)


def row_id_texts(html: Column, positions: int, matches: int = 2) -> Column:
    """Array of ``positions`` texts: number ``(k-1) * matches + m`` is match ``m`` of the row with
    id ``k``, in document order; null where there is none. A null page has none."""
    fold = _Fold(positions // matches, matches)
    start = F.struct(F.array().cast("array<struct<t:int,m:bigint,n:int,c:int,b:int>>").alias("stack"),
                     F.array_repeat(F.lit(None).cast("string"), positions).alias("out"))
    found = F.aggregate(_tokens(F.coalesce(html, F.lit("")), fold.rows), start, fold.step, lambda s: s["out"])

    def shown(t: Column) -> Column:
        t = F.regexp_replace(t, "<[^>]*>", "")
        for name, char in _ENTITIES:
            t = F.replace(t, F.lit(name), F.lit(char))
        return strip_ws(t)

    return F.transform(found, shown)
