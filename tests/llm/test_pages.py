"""HTML extraction and WARC archives: literal pages, round trips, byte ranges."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io

import pytest

from llm_session import llm  # noqa: F401
from quarry.llm import sitetree as tree
from quarry.llm import warc
from quarry.session import scratch_path


def text(html):
    blocks, _ = tree.parse(html)
    inside = [b for b in blocks if b[1]]
    return " ".join(b[2] for b in inside or blocks)


@pytest.mark.parametrize(
    "html, want",
    [
        ("", ""),
        ("plain  words\n here", "plain words here"),
        ("<body><nav><a>Home</a></nav><article><h1>T &amp; U</h1><p>One<b> two</b><br>three<p>four&nbsp;&#233;</article><footer>f</footer>", "T & U One two three four é"),
        ("<article><p>a</p><script>var x='</p>';</script><style>p{}</style><!-- c --><p>b</p></article>", "a b"),
        ("<article><p>cut off &am", "cut off &am"),
        ("<article><p>cut off</p><p cla", "cut off"),
        ("<article><p>a</p><aside>side</aside><div class='comments'><p>me too</p></div><form>f <input> g</form><p>b</p></article>", "a b"),
        ("<main><div class='cookie-notice'>We use</div><div id=sidebar>s</div><header><h1>H</h1></header><p>x</article> y</p></main>z", "H x y"),
        ("<body><header>Site</header><div role=navigation>m</div><div class=content><p>x</p></div><div class='ad'>buy</div></body>", "x"),
        ("<ul><li>a<li>b</ul><table><tr><td>c<td>d</table>", "a b c d"),
        ("<article><p title='a > b'>q < r</p><p hidden>no</p><textarea>t</textarea>e</article>", "q < r e"),
        ("<p>1</p></div></p><p>2", "1 2"),
        ("<article><div>pre<span>in</span>post</div></article>", "preinpost"),
        ("<script>never closed <p>x</p>", ""),
    ],
)
def test_parse(html, want):
    assert text(html) == want


@pytest.mark.parametrize(
    "tag, attrs, want",
    [
        ("article", "class='post comments-open'", "x"),
        ("article", "class='post category-social'", "x"),
        ("article", "class='post comments'", "x"),
        ("main", "class='has-sidebar'", "x"),
        ("div", "class='content with-sidebar'", "x"),
        ("section", "id='related-work'", "x"),
        ("div", "class='post tag-legal'", "x"),
        ("div", "class='box sidebar'", ""),
        ("div", "id=cookie-notice", ""),
        ("section", "class=related", ""),
    ],
)
def test_names_mark_whole_tokens(tag, attrs, want):
    assert text(f"<body><{tag} {attrs}><p>x</p></{tag}></body>") == want


PAGES = "page_id long, url string, html string, host string, text string, low int, digest int"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "h", "t", 1, 2) for r in rows], PAGES)


def test_site_tree_removes_what_a_host_repeats(llm):
    def page(i, box):
        return f"<body><div class=box>{box}</div><div class=content><p>Story {i} begins.</p><p>And {i * 7} ends.</p></div></body>"

    rows = [(i, f"http://a.org/{i}", page(i, "Follow us on everything")) for i in range(12)]
    rows += [(100 + i, f"http://b.org/{i}", page(i, f"Lead {i}")) for i in range(12)]
    rows += [(200 + i, f"http://c.org/{i}", page(1, "same page")) for i in range(12)]  # copies judge nothing
    rows += [(300, "http://d.org", page(1, "Follow us on everything")), (301, None, page(2, "x")), (302, "::bad[", None), (303, "http://a.org", "")]
    rows += [rows[0], (None, "http://a.org/9", page(3, "Follow us on everything")), (304, "http://a.org", "<p>" + "long &amp; " * 50_000)]
    out = tree.extract(pages(llm, rows).repartition(3), "page_id", "url", "html")
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    got = out.collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    by = {r.page_id: r.text for r in got}
    assert by[3] == "Story 3 begins. And 21 ends." == by[None]
    assert by[103] == "Lead 3 Story 3 begins. And 21 ends."
    assert by[203] == "same page Story 1 begins. And 7 ends."
    assert by[300].startswith("Follow us") and by[302] == by[303] == "" and len(by[304]) == 7 * 50_000 - 1
    assert tree.extract(pages(llm, []), "page_id", "url", "html").count() == 0


def test_site_tree_judges_what_is_outside_articles(llm):
    """A story beside teaser articles stays; unmarked boilerplate beside an article goes by the tree alone."""
    tease = lambda i: f"<article class=card><p>Teaser {i}</p></article><article class=card><p>Teaser {i + 1}</p></article>"
    rows = [(i, f"http://t.org/{i}", f"<body><div class=story><p>Story {i} begins.</p><p>And {i * 7} ends.</p></div>{tease(i)}</body>") for i in range(12)]
    box = "<div class=box>Follow us on everything</div>"
    rows += [(100 + i, f"http://u.org/{i}", f"<body>{box}<article><p>Story {i}.</p><p>More {i * 7}.</p></article><div class=note>Note {i}</div></body>") for i in range(12)]
    by = {r.page_id: r.text for r in tree.extract(pages(llm, rows).repartition(3), "page_id", "url", "html").collect()}
    assert by[3] == "Story 3 begins. And 21 ends. Teaser 3 Teaser 4"
    assert by[103] == "Story 3. More 21. Note 3"


def test_archives_round_trip(llm):
    rows = [(i, f"http://x.org/{i}?q=é ü", f"<p>page {i % 40}</p>" * (i % 9)) for i in range(200)]
    rows += [(500, None, None), (501, "u\r\nX-Bad: 1", "x"), (None, "n", "only"), (None, "n", "only"), (None, "n", "<p>page 1</p>"), rows[3]]
    rows += [(502, "big", "".join(f"{i:x}" for i in range(400_000)))]
    path = scratch_path(llm, "archive")
    warc.write_archives(pages(llm, rows).repartition(3), path, "page_id", "url", "html")
    want = []
    payloads = [(h or "").encode() for _, _, h in rows]
    last = {}
    for (i, _, _), b in zip(rows, payloads, strict=True):
        last[b] = max(last.get(b, -1), -1 if i is None else i)
    for (i, _, _), b in zip(rows, payloads, strict=True):
        digest = base64.b32encode(hashlib.sha1(b).digest()).decode()
        again = last[b] >= 0 and i != last[b]
        want.append((str(i if i is not None else ""), len(b), digest, "revisit" if again else "response", str(last[b]) if again else None, None if again else b))
    for split in (1 << 26, 1000, 97):  # ranges smaller than a record: each is read by the task it starts in
        got = warc.read_archives(llm, path, split).collect()
        rec = [(r.record_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload)) for r in got]
        assert sorted(rec, key=str) == sorted(want, key=str)
        assert len({(r.path, r.record_offset) for r in got}) == len(rows)
    assert {r.target_uri for r in got if r.record_id == "501"} == {"u%0D%0AX-Bad:%201"}
    raw = b"".join(bytes(r.content) for r in llm.read.format("binaryFile").load(path).collect())
    assert gzip.decompress(raw).count(b"WARC/1.1\r\n") == len(rows)  # plain concatenated gzip


def test_archive_of_nothing_and_small_payloads(llm):
    path = scratch_path(llm, "archive")
    warc.write_archives(pages(llm, []), path, "page_id", "url", "html")
    assert warc.read_archives(llm, path).count() == 0
    path = scratch_path(llm, "archive")
    warc.write_archives(pages(llm, [(1, "", "aa"), (2, "", "aa"), (3, "", "aaaa"), (4, "", "aaaa")]), path, "page_id", "url", "html", 3)
    got = {r.record_id: (r.record_type, r.refers_to) for r in warc.read_archives(llm, path).collect()}
    assert got == {"1": ("response", None), "2": ("response", None), "3": ("revisit", "4"), "4": ("response", None)}


def test_false_magic_is_passed_over():
    one = warc.record(1, "u", b"first", 5, "D", None)
    two = warc.record(2, "u", b"second", 6, "D", None)
    noise = warc.MAGIC + b"\x00 no member " + gzip.compress(b"not a record") + warc.MAGIC
    data = noise + one + warc.EMPTY_MEMBER + two
    starts = [len(noise), len(noise) + len(one) + len(warc.EMPTY_MEMBER)]
    for cut in range(0, len(data) + 1, 7):
        halves = [o for a, b in ((0, cut), (cut, len(data))) for o, _ in warc.members_in(io.BytesIO(data), a, b, chunk=16)]
        assert halves == starts
