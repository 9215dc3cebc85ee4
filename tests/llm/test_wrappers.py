"""HTML extraction against pages whose main text is known, and wrappers as regular expressions."""

import html
import os
import random
import re
from html.parser import HTMLParser

import pytest

from millrace.llm import wrappers
from millrace.llm.wrappers import CHILDREN, KEY, OPTIONAL, REPEATED, aligned, infer_wrappers, main_text, of_page, parse

SMALL = "/root/testdata/sf0.01"
SCHEMA = "page_id long, url string, html string, text int, _host string, n_chars string, score double"


def sequence(page):
    """Balanced labels of a page with `#` for texts."""
    out = []

    def walk(children):
        for child in children:
            if isinstance(child, str):
                if child.strip():
                    out.append("#")
            else:
                out.append(f"<{child[0]}>")
                walk(child[1])
                out.append("</>")

    walk(parse(page))
    return "".join(out)


def expression(nodes):
    """A wrapper as a regular expression over `sequence`; it has no union."""
    out = ""
    for node in nodes:
        body = "#" if node[KEY] == "#" else expression(node[CHILDREN])
        if node[KEY] != "#" and node[KEY][0] != "(":
            body = f"<{re.escape(node[KEY])}>{body}</>"
        out += f"(?:{body}){'*' if node[OPTIONAL] and node[REPEATED] else '?' if node[OPTIONAL] else '+' if node[REPEATED] else ''}"
    return out


def pages_of_one_host(rng, n=40):
    made = []
    for _ in range(n):
        body = "".join(
            rng.choice(["<p>x", "<p>x</p>", "<h2>x</h2><p>y</p>", "<ul><li>a<li>b</ul>", "<p><b>x<br>y</b></p>", "<img src=a>", "text"])
            for _ in range(rng.randint(0, 7))
        )
        made.append(f"<html><body><nav><a>m</a></nav>{'<div class=ad>b</div>' * rng.randint(0, 2)}<article>{body}</article></body>")
    return made


def test_wrappers_read_all_pages_they_were_made_of():
    for seed in range(25):
        pages = pages_of_one_host(random.Random(seed))
        halves = []
        for part in (pages[::2], pages[1::2]):
            wrapper = of_page(parse(part[0]))
            for page in part[1:]:
                wrapper = aligned(wrapper, of_page(parse(page)))
            halves.append(wrapper)
        whole = aligned(*halves)
        form = re.compile(expression(whole))
        assert "|" not in form.pattern.replace("\\|", "")
        assert all(form.fullmatch(sequence(p)) for p in pages)


def known_pages():
    """Pages of three templates, two without an article tag, and their main texts."""
    rng = random.Random(5)
    say = lambda n: " ".join(rng.choice(["über", "a<b", "R&D", "plain", "x &amp; y", "naïve", '"q"']) + str(rng.randint(0, 999)) for _ in range(n))
    rows = []
    for i in range(90):
        blocks = [say(rng.randint(3, 40)) for _ in range(rng.randint(1, 6))]
        code = [html.escape(b).replace(" ", rng.choice([" ", "\n\t", "&nbsp;", " <b></b>\n"]), 1) for b in blocks]
        kind = i % 3
        if kind == 0:
            url = f"https://News.example.org:8080/{i}"
            page = (
                f"<!DOCTYPE html><head><title>t{i}</title><script>if (a<b) '</p>'</script><body><header><h2>Site</h2></header><nav><ul><li><a href=x>Home</a></ul></nav>"
                f"<article><header><h1>{code[0]}</h1></header>" + "".join(f"<p>{c}" for c in code[1:])
                + f"<div class='share-bar'>Share {i}</div><aside>side {i}</aside></article><section id=comments><p>reader {i} wrote this</p></section><footer>f {i}</footer>"
            )
        elif kind == 1:
            url = f"http://www.example.com/a?b={i}"
            page = (
                "<html><body><div class=top><a href=/>Start</a> <a href=/x>More</a> <a href=/y>Other long menu entry</a></div><div class=notice>We use cookies</div>"
                f"<div class=content><h1>{code[0]}</h1>" + "".join(f"<div>{c}</div>" for c in code[1:])
                + "</div><div class=bottom>All rights stay with the house of example texts</div></body></html>"
            )
        else:
            url = f"http://user@shop.example.net/{i}"
            page = "<main>" + "<br/>".join(code).replace("\n", "<!-- c --> ") + "</main><form>Name <input name=n><button>Go</button></form>"
            blocks = [" ".join(blocks)]
        rows.append((i, url, page, "\n\n".join(" ".join(b.split()) for b in blocks)))
    return rows


@pytest.mark.parametrize("tasks", [1, 7])
def test_main_text_of_known_pages(spark, tasks):
    rows = known_pages()
    frame = spark.createDataFrame([(i, u, h, 1, "x", "y", 0.5) for i, u, h, _ in rows], SCHEMA).repartition(tasks)
    found = main_text(frame)
    assert found.columns == ["page_id", "url", "html", "_host", "score", "text", "n_chars"]
    got = {r.page_id: (r.text, r.n_chars) for r in found.collect()}
    assert got == {i: (t, len(t)) for i, _, _, t in rows}


def test_awkward_pages(spark, monkeypatch):
    monkeypatch.setattr(wrappers, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(wrappers, "FAN_IN", 2)
    long = "<article>" + "<p>word word</p>" * 30_000 + "</article>"
    deep = "<div>" * 5_000 + "deep" + "</div>" * 5_000
    rows = [(1, None, None), (2, None, ""), (3, "no address", "just text & more"), (4, "http://a.org/", "<article>&lt;p&gt; &am &#233;&copy</article>")]
    rows += [(5, "http://b.org/1", long), (6, "http://c.org", deep), (7, "http://d.org", "<p>twice"), (7, "http://d.org", "<p>twice"), (None, "http://e.org", "<script>x")]
    frame = spark.createDataFrame([(*r, 1, "x", "y", 0.5) for r in rows], SCHEMA).repartition(5)
    got = [(r.page_id, r.text) for r in main_text(frame).collect()]
    wanted = [(1, ""), (2, ""), (3, "just text & more"), (4, "<p> &am é©"), (5, "\n\n".join(["word word"] * 30_000)), (6, "deep")]
    assert sorted(got, key=repr) == sorted(wanted + [(7, "twice"), (7, "twice"), (None, "")], key=repr)
    assert main_text(frame.limit(0)).count() == 0
    assert infer_wrappers(frame).groupBy("_host").count().where("count > 1").count() == 0


class Articles(HTMLParser):
    """Blocks of the article of a page of the test tables, which use few tags."""

    def __init__(self):
        super().__init__()
        self.inside, self.parts, self.blocks = False, [], []

    def _end(self):
        text = " ".join("".join(self.parts).split())
        self.blocks += [text] if text else []
        self.parts = []

    def handle_starttag(self, tag, attrs):
        if tag in ("p", "h1", "article"):
            self._end()
        self.inside |= tag == "article"
        self.parts += [" "] if tag == "br" else []

    def handle_endtag(self, tag):
        if tag in ("p", "h1", "article"):
            self._end()
        self.inside &= tag != "article"

    def handle_data(self, data):
        self.parts += [data] if self.inside else []


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables are not here")
def test_query_equals_a_parser(spark):
    from millrace.llm.queries import QUERIES

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    found = {r.page_id: r.text for r in QUERIES["op11_html_extraction"](spark, SMALL).collect()}
    wanted = {}
    for key, page in pages.items():
        parser = Articles()
        parser.feed(page or "")
        parser.close()
        wanted[key] = "\n\n".join(parser.blocks)
    assert found == wanted and sum(map(len, wanted.values())) > 0
