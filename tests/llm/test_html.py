"""Rendered pages, written out by hand."""

import random
import time

import pytest

from strata.llm.html_extract import extract_text, op8_html_text, page_text

CASES = {
    "blocks": ("<h1>A</h1><p>one <b>two</b>\n three</p><div>x</div><div>y</div>z", "A\n\none two three\n\nx\ny\nz"),
    "implied ends": ("<p>a<p>b<div>c</div><ul><li>d<li>e</ul>", "a\n\nb\n\nc\n\n- d\n- e"),
    "nested lists": ("<ol start=3><li>x<ul><li>y</ul><li>z</ol>", "3. x\n   - y\n4. z"),
    "hidden": (
        "a<span style='display : NONE'>b</span><i hidden>c</i><script>d</script><style>e</style>"
        "<template>f</template><noscript>g</noscript><!-- h --><input type=hidden value=i><b style='color:red'>j</b>",
        "aj",
    ),
    "head": ("<html><head><title>t</title><meta name=x></head><body>b</body></html>", "b"),
    "head without end": ("<head><title>t</title><p>b", "b"),
    "table": (
        "<table><caption>C</caption><tr><th>Name<th>Qty<tr><td>Pear<td>7<tr><td colspan=2>all<tr><td><td>9</table>",
        "C\nName  Qty\nPear  7\nall\n      9",
    ),
    "cell lines": ("<table><tr><td>a<br>b<td>c</table>", "a  c\nb"),
    "nested table": ("<table><tr><td><table><tr><td>in</table><td>out</table>", "in  out"),
    "pre": ("<pre>a\n  b\n\nc</pre>d", "a\n  b\n\nc\n\nd"),
    "breaks": ("a<br>b<br/>c</br>d", "a\nb\nc\nd"),
    "entities": ("&lt;a&gt;&nbsp;&amp;&eacute;&#x41;", "<a> &éA"),
    "quote": ("<blockquote>q<p>r</blockquote>s", "  q\n\n  r\n\ns"),
    "stray ends": ("</div></p>a</b></table>b</ul>", "ab"),
    "damaged": ("a<b class='x' <i>c", "a"),
    "definition": ("<dl><dt>t<dd>d<dt>u<dd>e</dl>", "t\n  d\nu\n  e"),
    "blank": ("  \n\t ", ""),
}


@pytest.mark.parametrize("name", [n for n in CASES if n != "damaged"])
def test_rendering(name):
    html, want = CASES[name]
    assert page_text(html) == want


def test_damaged_and_deep_pages():
    assert page_text(None) == page_text("") == ""
    assert page_text("a<b class='x' <i>c").startswith("a")
    assert page_text("<div>" * 20_000 + "x") == "x"
    assert "x" in page_text("<table><tr><td>" * 60 + "x")
    assert page_text("<!DOCTYPE html><a href='").strip() in ("", "<a href='")


def test_every_word_is_kept_in_order():
    words = [f"w{i}" for i in range(400)]
    parts, tags = [], ["<p>", "<div>", "<li>", "<br>", "<td>", "<b>", "</b>", "</p>", "<h2>", "</div>"]
    for i, w in enumerate(words):
        parts.append(tags[i * 7 % len(tags)] + w + " ")
    assert sorted(page_text("".join(parts)).replace("- ", "").split()) == sorted(words)


def test_operator_passes_other_columns(spark):
    rows = [(1, "u", "<p>a", "old"), (1, "u", "<p>a", "old"), (2, None, None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    out = extract_text(df)
    assert out.columns == df.columns
    assert sorted((r["page_id"], r["text"]) for r in out.collect()) == [(1, "a"), (1, "a"), (2, "")]


@pytest.mark.parametrize("row", ["<tr><td>a<td>b", "<thead><tr><td>a<td>b", "<tbody><tr><td>a<td>b", "<tfoot><tr><td>a<td>b"])
def test_a_column_group_without_end_keeps_the_rows(row):
    assert page_text(f"<table><colgroup><col><col>{row}</table>") == "a  b"
    assert page_text(f"<table><colgroup><colgroup span=2>{row}</table>c") == "a  b\n\nc"
    assert page_text(f"<table><caption>C<colgroup><col>{row}</table>") == "C\na  b"


def test_a_column_group_ends_at_anything_but_columns():
    assert page_text("<table><colgroup><col><td>a<td>b</table>") == "a\nb"
    assert page_text("<table><colgroup><template>t</template><col><caption>C</caption><tr><td>a</table>") == "C\na"
    assert page_text("<table><colgroup>x<b>y</b><tr><td>a</table>") == "xy\na"


FOREIGN = {
    "closed svg": ('<button><svg class="i"/>Buy</button> now', "Buy now"),
    "closed math": ("<p>a<math/>b", "ab"),
    "closed inside": ("<p><svg><g><path d='x'/></g><circle/></svg>Buy", "Buy"),
    "not closed": ("<div><svg><path><g></svg>Buy</div>", "Buy"),
    "ended by HTML": ("<svg><path><p>Buy", "Buy"),
    "svg text": ("<svg>no<title>no</title><g><text>a <tspan>b</tspan></text></g><text>c</text></svg>d", "a b c d"),
    "svg not drawn": ("<svg><defs><text>no</text></defs><text display='none'>no</text><desc>no</desc></svg>a", "a"),
    "svg with HTML": ("<svg><foreignObject><p>a<p>b<div/>c</foreignObject></svg>d", "a\n\nb\n\nc\nd"),
    "math text": ("let <math><mi>x</mi><mo>=</mo><mn>1</mn></math>.", "let x=1."),
    "math parts": ("<math><mfrac><mn>1</mn><mn>2</mn></mfrac></math>", "1 2"),
    "math annotation": (
        "<math><semantics><mi>x</mi><annotation encoding='tex'>no</annotation></semantics></math>", "x",
    ),
    "buttons": (
        "<input type=submit value=Go><input type=BUTTON value='Add it'><input type=reset value=Undo>"
        "<input type=hidden value=no><input type=submit><input type=submit value=no hidden>",
        "Go Add it Undo",
    ),
}


@pytest.mark.parametrize("name", FOREIGN)
def test_drawings_formulas_and_buttons(name):
    html, want = FOREIGN[name]
    assert page_text(html) == want


SEEN = {
    "inherited": ("a<div style='visibility:hidden'>b<p>c<span style='visibility: VISIBLE'>d</span>e</div>f", "a\n\nd\n\nf"),
    "taken out": ("a<div style='display:none'>b<span style='visibility:visible'>c</span></div>d", "ad"),
    "last wins": ("<i style='display:none;display:inline'>a</i><i style='visibility:hidden;visibility:visible'>b</i>", "ab"),
    "hidden but shown": ("<i hidden style='display:inline'>a</i><i hidden=until-found>b</i>", "a"),
    "closed details": ("<details>a<summary>b</summary><p>c<summary>d</summary></details>e", "b\ne"),
    "open details": ("<details open><summary>b</summary>c</details>", "b\nc"),
    "dialogs": ("a<dialog>b</dialog><dialog open>c</dialog>", "a\nc"),
    "ruby": ("<ruby>a<rp>(</rp><rt>b</rt><rp>)</rp></ruby>", "ab"),
    "rowspan": ("<table><tr><td rowspan=2>A<td>B<tr><td>C<tr><td>D<td>E</table>", "A  B\n   C\nD  E"),
    "rowspan to the end": ("<table><tr><td>x<td rowspan=0>y<td>z<tr><td>a<td>b<tr><td>c<td>d</table>", "x  y  z\na     b\nc     d"),
    "both spans": ("<table><tr><td rowspan=2 colspan=2>A<td>B<tr><td>C<tr><td>1<td>2<td>3</table>", "A     B\n      C\n1  2  3"),
    "wide span": ("<table><tr><td colspan=1000>all<tr><td>a<td>b</table>", "all\na  b"),
    "hidden row": ("<table><tr style='visibility:collapse'><td>a<td style='visibility:visible'>b<tr><td>c<td>d</table>", "   b\nc  d"),
    "hidden table": ("<table style='visibility:hidden'><caption>x<tr><td>a<td><b style='visibility:visible'>b</b></table>", "  b"),
    "hidden svg": ("<svg><g visibility='hidden'><text>a</text><g visibility='visible'><text>b</text></g></g></svg>", "b"),
    "hidden items": ("<ul><li>a<li style='visibility:hidden'>b<li>c</ul>", "- a\n- c"),
}


@pytest.mark.parametrize("name", SEEN)
def test_what_is_seen(name):
    html, want = SEEN[name]
    assert page_text(html) == want


TAGS = "div p b span ul li section h2 details dialog blockquote i table td summary".split()
STYLES = ["", "", "", "", " hidden", " style='display:none'", " style='visibility:hidden'", " style='visibility:visible'", " open"]


def grown(rng, depth, words):
    """A random tree: (tag, attribute, children), or a word."""
    if depth == 0 or rng.random() < 0.3:
        words.append(f"w{len(words)}")
        return words[-1]
    tag = rng.choice(TAGS[:12])
    kids = [grown(rng, depth - 1, words) for _ in range(rng.randrange(1, 5))]
    if tag == "details":
        kids.insert(rng.randrange(len(kids) + 1), ("summary", "", [grown(rng, 0, words)]))
    if tag == "p":  # a block would end it
        kids = [k for k in kids if isinstance(k, str) or k[0] in ("b", "i", "span") and all(isinstance(x, str) for x in k[2])]
    node = (tag, rng.choice(STYLES), kids)
    return ("ul", "", [node]) if tag == "li" else node  # an item would end the one around it


def written(node):
    if isinstance(node, str):
        return f" {node} "
    tag, attr, kids = node
    inner = "".join(map(written, kids))
    return f"<{tag}{attr}>{inner}</{tag}>"


def seen(node, visible=True):
    """The words a reader sees, by the rules, from the tree itself."""
    if isinstance(node, str):
        return [node] if visible else []
    tag, attr, kids = node
    if attr in (" hidden", " style='display:none'") or tag == "dialog" and attr != " open":
        return []
    if "visibility" in attr:
        visible = "visible'" in attr
    if tag == "details" and attr != " open":
        kids = [k for k in kids if not isinstance(k, str) and k[0] == "summary"][:1]
    return [w for k in kids for w in seen(k, visible)]


@pytest.mark.parametrize("seed", range(40))
def test_all_that_is_seen_by_a_plain_walk(seed):
    rng, words = random.Random(seed), []
    trees = [grown(rng, 5, words) for _ in range(4)]
    got = [w for w in page_text("".join(map(written, trees))).split() if w != "-"]
    assert got == [w for t in trees for w in seen(t)]


def test_reading_is_linear_in_the_nesting():
    def seconds(n):
        html = "<div><svg><foreignobject>" * (n // 3) + "<p>x<li>y"
        best = []
        for _ in range(3):
            t = time.perf_counter()
            page_text(html)
            page_text("<b>" * n + "</i>" * n)
            best.append(time.perf_counter() - t)
        return min(best)

    assert seconds(40_000) < 3.5 * seconds(20_000)


def test_query_on_a_small_table(spark, tmp_path):
    cases = [*CASES.values(), *FOREIGN.values(), *SEEN.values(), (None, "")]
    rows = [(i, f"u{i}", html) for i, (html, _) in enumerate(cases)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    out = {r["page_id"]: r for r in op8_html_text(spark, str(tmp_path)).collect()}
    assert len(out) == len(cases) and all(out[i]["url"] == f"u{i}" for i in out)
    for i, (html, want) in enumerate(cases):
        assert out[i]["text"] == want or html == CASES["damaged"][0]
