"""The short way through plain pages against the parser of any page."""

import random

from barloom.sources import pages as P

PARTS = [
    "<table>", "</table>", "<tr>", "</tr>", "<td>", "</td>", "<TH class='a b' x=1>", "</th >", "<tbody>", "</thead>", "<b>", "<br/>",
    "<td />", "<td/>", " a ", "x &amp; y", "&lt", "&#65;", "<!-- c -->", "<!-- a > b -->", "<!doctype html>", "< x", "<", "a<b",
    "<script>if (a<b) '</td>'</script>", "<title>t &amp; <b></title>", '<td a="x>y">', "<td a=b/>", "</td x>", "\n", "é", "&am", "<1>",
    "</>", "<![CDATA[x]]>", "<textarea>", "<td a =b c>", '<td a="b"c>', "<td\x0b>", "<tdé>",
]


def parsed(html):
    builder = P._Builder()
    parser = P._Parser(builder)
    parser.feed(html)
    parser.close()
    return builder.tables


def test_plain_pages_equal_the_parser():
    rng = random.Random(2)
    plain = 0
    for _ in range(3000):
        n = len(PARTS) if rng.random() < 0.3 else 20
        html = "<table>" + "".join(rng.choice(PARTS[:n]) for _ in range(rng.randint(0, 14)))
        plain += P._plain_tokens(html) is not None
        for tight in (False, True):
            assert P._rows_array([P._tables(html)], tight).equals(P._rows_array([parsed(html)], tight))
    assert plain > 500
    assert P._rows_array([], True).to_pylist() == [] and P._rows_array([[], []], False).to_pylist() == [[], []]
    assert P._plain_tokens("<table><script>1</script></table>") is None


def test_rows_do_not_carry_the_tables_of_their_page(spark):
    pages = spark.createDataFrame([(1, "<table><tr><th>a</th></tr><tr><td>1</td></tr></table>")], "page_id bigint, html string")
    plan = P.extract_records(pages)._jdf.queryExecution().optimizedPlan().toString()
    generate = next(line for line in plan.splitlines() if "Generate" in line)
    assert "tables" not in generate
    assert plan.count("RLIKE") == 1 and [r["record"] for r in P.extract_records(pages).collect()] == [{"a": "1"}]
