"""Gauges of nested tables in column expressions, against a tree parser and by hand."""

import random

import pytest
from pyspark.sql import functions as F

from supplyscope.sources import tablefold as TF
from tests.htmltree import row_id_texts


def fold(spark, pages, positions=8):
    df = spark.createDataFrame(list(enumerate(pages)), "i int, html string").repartition(2)
    got = df.select("i", TF.row_id_texts(F.col("html"), positions).alias("g")).collect()
    return [list(r.g) for r in sorted(got)]


def inner(*cells):
    return "<table>" + "".join(f"<tr><td>n</td><td>{c}</td></tr>" for c in cells) + "</table>"


def row(k, *cells):
    return f'<tr id="{k}"><td>n</td><td><table><tr><td>{inner(*cells)}</td></tr></table></td></tr>'


def only(**at):
    return [at.get(f"g{i}") for i in range(8)]


CASES = [
    (None, only()), ("", only()), ("no table here < at all", only()),
    (f"<table>{row(1, '80%', '60%')}{row(4, '1%', '2%')}</table>", only(g0="80%", g1="60%", g6="1%", g7="2%")),
    # Unclosed cells and rows, single quotes, upper case, quoted ">", attributes before the id.
    ("<TABLE><TR CLASS='a>b' ID='2'><TD>n<TD><TABLE><TR><TD><TABLE><TR><TD>x<TD> 7&nbsp;% <TR><TD>x<TD><b>8</b>%</TABLE></TABLE>"
     "</TABLE>", only(g2="7 %", g3="8%")),
    # Explicit and implied sections; a head's rows are not on the path.
    (f"<table><tbody><tr id=1><td>n</td><td><table><tbody><tr><td>{inner('5%')}</td></tr></tbody></table></td></tr></tbody></table>",
     only(g0="5%")),
    (f"<table><tr id=1><td>n<td><table><thead><tr><td>{inner('5%')}</td></tr></thead></table></table>", only()),
    # The second td, not the second cell; a th counts for nothing.
    (f"<table><tr id=1><td>n<th>h<td><table><tr><th>h<td>{inner('5%')}</table></table>", only(g0="5%")),
    (f"<table><tr id=1><th>h<td><table><tr><td>{inner('5%')}</table></table>", only()),
    # A cell without a row stands in an implied one.
    (f"<table><tr id=1><td>n<td><table><td>{inner('5%')}</table></table>", only(g0="5%")),
    # Only the first matches count, in document order, also of a repeated id.
    (f"<table>{row(1, '1%', '2%', '3%')}{row(1, '4%')}</table>", only(g0="1%", g1="2%")),
    (f"<table>{row(1, '1%')}{row(1, '4%')}{row(1, '5%')}</table>", only(g0="1%", g1="4%")),
    # A row with an id inside a gauge's own cell.
    (f"<table>{row(1, f'a<table>{row(2, chr(98))}</table>c')}</table>", only(g0="annbc", g2="b")),
    # Other ids, ids of other elements, ids in data attributes.
    (f"<table>{row(9, '1%')}{row('01', '2%')}<div id=1>{inner('3%')}</div></table>", only()),
    (f"<table><tr data-id=1><td>n<td><table><tr><td>{inner('5%')}</table></table>", only()),
    # Comments and scripts hide their tags; stray end tags close nothing.
    (f"<!-- <table>{row(1, '9%')}</table> --><script>'<table>'</script></table></tr><table></td>{row(1, '5%')}</table>", only(g0="5%")),
    # Table elements outside a table are none.
    (row(1, "5%").replace("<table>", "").replace("</table>", ""), only()),
    # Cut off in the middle of a gauge: what is there counts.
    (f"<table>{row(1, '80%')}"[:-40], only(g0="80%")),
    ("<<<>>><td><tr id='1'<table", only()),
]


def test_by_hand(spark):
    got = fold(spark, [p for p, _ in CASES])
    for (page, want), g in zip(CASES, got):
        assert g == want, page


def test_deep_pages(spark):
    deep = "<table><tr><td>" * 1000 + f"<table>{row(3, '5%', '6%')}</table>" + "</td></tr></table>" * 1000
    assert fold(spark, ["<p>" * 3000, "<b>" * 3000 + f"<table>{row(1, '5%')}</table>", deep, "<table>" * 3000,
                        "<td a='" + "x" * 50_000 + "'>" + "<" * 5000]) == [
        only(), only(g0="5%"), only(g4="5%", g5="6%"), only(), only()]


def random_table(rng, depth):
    """Well-formed tables with ids, sections and markup at any depth."""
    rows = []
    for _ in range(rng.randint(1, 3)):
        cells = []
        for _ in range(rng.randint(0, 3)):
            body = rng.choice(["5%", "", "<b>7</b>", "a <i>b</i>"])
            if depth and rng.random() < 0.6:
                body += random_table(rng, depth - 1) + rng.choice(["", "tail"])
            cells.append(f"<td>{body}</td>")
        ident = rng.choice(["", "", f' id="{rng.randint(1, 5)}"', f" class=x id='{rng.randint(1, 4)}'"])
        rows.append(f"<tr{ident}>{''.join(cells)}</tr>")
    whole = "".join(rows)
    return f"<table>{rng.choice([whole, f'<tbody>{whole}</tbody>'])}</table>"


@pytest.mark.parametrize("seed", range(3))
def test_random_tables_against_a_tree(spark, seed):
    rng = random.Random(seed)
    pages = [random_table(rng, 4) for _ in range(60)]
    want = []
    for p in pages:
        tree = row_id_texts(p, 8)
        want.append(tree)
    got = fold(spark, pages)
    assert sum(x is not None for w in want for x in w) > 5
    # Where rows with an id are nested in each other, the parser lists matches row by row, a browser in document order.
    for page, g, w in zip(pages, got, want):
        assert [x is not None for x in g] == [x is not None for x in w]
        if all(page.count(f"id={q}{k}{q}") <= 1 for k in range(1, 5) for q in "\"'"):
            assert g == w, page


def test_no_python_in_the_plan(spark):
    from supplyscope.plans import catalog

    for name in ("extract_gauges_row_id", "gauges_to_supplies"):
        plan = catalog.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Exchange" not in plan
