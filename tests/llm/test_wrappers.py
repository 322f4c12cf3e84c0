import random
import time

from hypothesis import given, settings
from hypothesis import strategies as st

from paperloom.llm import wrappers

SCHEMA = "page_id bigint, url string, html string, host string, wrapper string, keys string"


def _page(r, i):
    """A page of a site with a fixed template, a list of links, a subtitle that may lack, and paragraphs; and its content."""
    title, paragraphs = f"Title of {i}", [f"Paragraph {i} {k} &amp; more" for k in range(r.randint(1, 6))]
    sub = f"<h2 class='sub'>Subtitle {i}</h2>" if r.random() < 0.5 else ""
    links = "".join(f"<li><a href='/{k}'>link {i} {k}</a></li>" for k in range(r.randint(1, 5)))
    html = f"<!DOCTYPE html><html><head><title>{title}</title><script>var x = '<p>no</p>';</script></head><body><nav><ul>{links}</ul></nav><div class=\"ad\">Buy now</div><h1>{title}</h1>{sub}{''.join(f'<p>{p}</p>' for p in paragraphs)}<p class=legal>All rights reserved by the owner</p><footer>Contact us</footer></body></html>"
    return html, [title, *([f"Subtitle {i}"] if sub else []), *(p.replace("&amp;", "&") for p in paragraphs)]


def _site(n=40, seed=1):
    r = random.Random(seed)
    return [_page(r, i) for i in range(n)]


def test_the_template_goes_and_the_content_stays(spark):
    site = _site()
    pages = spark.createDataFrame([(i, f"https://a.example.com/{i}", html, "x", "y", "z") for i, (html, _) in enumerate(site)], SCHEMA).repartition(3)
    got = {r["page_id"]: r["text"].split("\n") for r in wrappers.extract(pages).collect()}
    assert got == {i: content for i, (_, content) in enumerate(site)}


def test_the_wrapper_is_a_union_free_expression(spark):
    pages = spark.createDataFrame([(i, "https://a.example.com/", html, "x", "y", "z") for i, (html, _) in enumerate(_site())], SCHEMA)
    (w,) = wrappers.wrappers(pages).collect()
    assert w["pages"] == 40 and "|" not in w["regex"]
    assert "<ul>(<li><a>#</a></li>)+</ul>" in w["regex"] and "(<h2 class=sub>#</h2>)?" in w["regex"] and "(<p>#</p>)+" in w["regex"]
    assert "Buy now" in w["regex"] and "All rights reserved by the owner" in w["regex"]


def test_it_does_not_depend_on_the_spread_of_pages(spark):
    pages = spark.createDataFrame([(i, f"https://{'ab'[i % 2]}.example.com/", html, "x", "y", "z") for i, (html, _) in enumerate(_site(60, 2))], SCHEMA)
    one = sorted(map(str, wrappers.wrappers(pages.coalesce(1)).collect()))
    assert one == sorted(map(str, wrappers.wrappers(pages.repartition(5, "page_id")).collect()))


def test_odd_pages_and_empty_table(spark):
    rows = [(1, None, "<p>x</p>"), (2, "", ""), (3, "https://a.example.com", None), (4, "https://a.example.com", "no tags at all"), (5, "https://b.example.com", "<p>same</p>"), (5, "https://b.example.com", "<p>same</p>"), (None, "https://c.example.com", "<p>" * 3000 + "deep" + "</p>" * 3000), (6, "https://c.example.com", "<p>x</p>" * 20_000), (7, "https://d.example.com", "<!-- never closed <p>x</p>"), (8, "https://d.example.com", "<b>bold <i>both</b> i</i> &lt;")]
    got = wrappers.extract(spark.createDataFrame([(*r, "h", "w", "k") for r in rows], SCHEMA)).collect()
    by = {r["page_id"]: r["text"] for r in got}
    assert len(got) == len(rows)
    assert by[1] == "x" and by[2] == by[3] == "" and by[4] == "no tags at all" and by[None] == "deep" and by[6].count("x") == 20_000 and by[7] == "" and by[8] == "bold\nboth\ni\n<" and by[5] == "same"
    assert wrappers.extract(spark.createDataFrame([], SCHEMA)).count() == 0


def test_long_pages_take_time_in_proportion():
    r = random.Random(1)
    for page in ("line of text<br>" * 64_000, "<li>item number" * 64_000, "<div>" * 60_000 + "x", "".join(f"<p>x</p>{'<br>' * r.randint(0, 3)}y" for _ in range(40_000))):
        began = time.time()
        keys, texts = wrappers.tokens(page)
        nodes = wrappers.fold(tuple(keys))
        assert nodes[-1][2] == len(keys) and time.time() - began < 30


def test_unlike_long_pages_are_aligned_in_little_memory():
    r = random.Random(2)
    a, b = ([r.choice("abcdefgh") for _ in range(8000)] for _ in range(2))
    began = time.time()
    pairs = wrappers.align(a, b)
    assert len(pairs) > 4000 and all(a[i] == b[j] for i, j in pairs) and time.time() - began < 60


def test_a_wrapper_does_not_change_with_its_shares(spark):
    """Many shapes of one host, so that several shares are merged: the content comes out as from one."""
    site = _site(120, 7)
    pages = spark.createDataFrame([(i, "https://a.example.com/", html.replace("<h1>", f"<h1 class=c{i % 30}>"), "x", "y", "z") for i, (html, _) in enumerate(site)], SCHEMA)
    got = {r["page_id"]: r["text"].split("\n") for r in wrappers.extract(pages).collect()}
    assert sum(got[i] == content for i, (_, content) in enumerate(site)) >= 0.95 * len(site)


KEYS = st.lists(st.sampled_from(["a", "/a", "b", "/b", "#"]), max_size=24).map(tuple)


@settings(max_examples=200, deadline=None)
@given(KEYS)
def test_folding_keeps_all_tokens(keys):
    nodes = wrappers.fold(keys)
    assert [n[1] for n in nodes] == [0, *[n[2] for n in nodes[:-1]]] if nodes else not keys
    assert not nodes or nodes[-1][2] == len(keys)


@settings(max_examples=200, deadline=None)
@given(KEYS, KEYS)
def test_alignment_is_the_heaviest(a, b):
    pairs = wrappers.align(list(a), list(b))
    assert sum(wrappers._weight(a[i]) for i, _ in wrappers.align(list(a), list(b), 4)) == sum(wrappers._weight(a[i]) for i, _ in pairs)
    assert all(a[i] == b[j] for i, j in pairs) and all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:], strict=False))
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = max(best[i + 1][j], best[i][j + 1], best[i + 1][j + 1] + wrappers._weight(a[i]) if a[i] == b[j] else 0)
    assert sum(wrappers._weight(a[i]) for i, _ in pairs) == best[0][0]
