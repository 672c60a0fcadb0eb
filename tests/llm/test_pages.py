from __future__ import annotations

import hashlib

import brute
import zstandard

from tallyhouse.llm import shared_files, warc, wrappers

PAGES = "page_id bigint, url string, html string"


def page(body: str, menu: str = "Home", extra: str = "") -> str:
    return (
        f'<!DOCTYPE html><html><head><title>{menu}</title><script>var t="</p>";</script></head><body><nav><ul><li><a href="/">{menu}</a></li>'
        f'<li><a href="/x">News</a></li></ul></nav><!-- ad > --><div class="ad">Buy {menu} now.</div>{extra}<article>{body}</article>'
        '<section id="comments"><p>Great post!</p></section><aside>More</aside><footer>&copy; me</footer>'
    )


def test_main_text(spark, prose):
    rows = []
    for i in range(30):
        body = f"<h1>Title {i} &amp; more</h1>" + "".join(f"<p>{prose(100 * i + j, 20)} a<b>b</b>c\n x</p>" for j in range(1 + i % 5))
        rows.append((i, f"https://h{i % 2}.example/p/{i}", page(body, f"m{i}", "<form>Name <input></form>" if i % 3 else "")))
    found = {r.page_id: r for r in wrappers.main_texts(spark.createDataFrame(rows, PAGES)).collect()}
    assert len(found) == 30
    for i, url, html in rows:
        assert (found[i].url, found[i].text, found[i].n_chars) == (url, brute.article(html), len(brute.article(html)))


def test_text_without_an_article_element(spark, prose):
    def plain(i: int) -> str:
        return (
            f'<body><div class="top"><a href="/">Home</a> <a href="/b">Blog</a></div><div class="left"><div class="c1"><h4>Read this first</h4>'
            f'<p>{prose(i, 80)}</p><p>{prose(i + 500, 60)}</p></div></div><div class="sidebar"><p>{prose(i + 900, 30)}</p></div></body>'
        )

    rows = [(i, "http://x.example/", plain(i)) for i in range(12)]
    for r in wrappers.main_texts(spark.createDataFrame(rows, PAGES)).collect():
        # What all pages share at one place is the template's.
        assert r.text == f"{prose(r.page_id, 80)} {prose(r.page_id + 500, 60)}"


def test_copies_of_a_page_do_not_fill_the_sample(spark, prose):
    def plain(i: int) -> str:
        return f'<body><div class="c1"><h4>Read this first</h4><p>{prose(i, 80)}</p><p>{prose(i + 500, 60)}</p></div></body>'

    rows = [(i, "http://x.example/", plain(i % 12)) for i in range(240)]
    for r in wrappers.main_texts(spark.createDataFrame(rows, PAGES)).collect():
        assert r.text == f"{prose(r.page_id % 12, 80)} {prose(r.page_id % 12 + 500, 60)}"


def texts_of(spark, rows):
    return {r.page_id: r.text for r in wrappers.main_texts(spark.createDataFrame(rows, PAGES)).collect()}


def test_the_weight_of_slots_decides_not_names(spark, prose):
    """Random class names, no article or nav: the wrapper alone tells text from template."""

    def plain(i: int) -> str:
        body = "".join(f"<p>{prose(100 * i + j, 40)}</p>" for j in range(3 + i % 4))
        return (
            '<body><div class="qz"><a href="/">Start</a> <a href="/b">More of it</a></div><div class="kf"><div class="wu"><h4>Filed under things</h4>'
            f'<h1>{prose(i + 7000, 6)}</h1>{body}<p class="vv">All rights with the house</p></div></div><div class="xj"><p>{prose(i + 9000, 12)}</p></div></body>'
        )

    found = texts_of(spark, [(i, "http://x.example/", plain(i)) for i in range(40)])
    for i in range(40):
        paragraphs = [prose(100 * i + j, 40) for j in range(3 + i % 4)]
        assert found[i] == " ".join([prose(i + 7000, 6), *paragraphs])


def test_an_article_inside_a_container_with_an_outside_name(spark, prose):
    def plain(i: int) -> str:
        return (
            f'<body><div class="top-menu"><a href="/">Home</a></div><div class="social-history"><p>{prose(i, 80)}</p><p>{prose(i + 500, 60)}</p>'
            f'<div class="share">Share it {i}</div></div><div class="sidebar"><p>{prose(i + 900, 9)}</p></div></body>'
        )

    found = texts_of(spark, [(i, "http://x.example/", plain(i)) for i in range(12)])
    assert found == {i: f"{prose(i, 80)} {prose(i + 500, 60)}" for i in range(12)}


def test_every_page_and_all_of_it_is_evidence(spark, prose):
    """A text that only the first 14 pages share is no template's; one behind 3,000 tokens is."""

    def plain(i: int) -> str:
        rows = "".join(f"<p>{prose(10 * i, 5)} {j}</p>" for j in range(1000))
        first = "Only some pages begin so" if i < 14 else prose(i + 300, 5)
        return f'<body><div class="c1"><h4>{first}</h4>{rows}<h5>Printed by the house</h5></div></body>'

    found = texts_of(spark, [(i, "http://x.example/", plain(i)) for i in range(40)])
    assert found[3].startswith("Only some pages begin so") and found[30].startswith(prose(330, 5))
    assert all(found[i].endswith(" 999") for i in found)


def test_two_templates_of_a_host(spark, prose):
    def plain(i: int) -> str:
        kind = "news" if i % 3 else "blog"
        return f'<body><div class="{kind}"><h4>Head of {kind}</h4><p>{prose(i, 80)}</p></div></body>'

    found = texts_of(spark, [(i, "http://x.example/", plain(i)) for i in range(60)])
    assert found == {i: prose(i, 80) for i in range(60)}


def test_partial_wrappers_count_all_pages(spark, prose):
    rows = [(i, "http://x.example/", f"<body><h4>Head</h4><p>{prose(i, 30)}</p></body>") for i in range(120)]
    table = spark.createDataFrame(rows + rows[:50], PAGES).repartition(40)
    table = table.selectExpr("'h' as host", "html")
    parts = wrappers.different(table).mapInArrow(wrappers._partials, wrappers.PARTIAL).collect()
    assert len(parts) > wrappers.FAN_IN and sum(r.pages for r in parts) == 120
    assert wrappers.wrappers(table).count() == 1


def test_a_majority_outlives_merging():
    texts = ["same"] * 18 + ["other", "third"]
    nodes = wrappers.wrapper_of([f"<p>{t}</p><i>{n}</i>" for n, t in enumerate(texts)])
    first, second = (n for n in nodes if n.key == "")
    assert (first.text, first.pages, second.text) == ("same", 20, None)


def test_long_streams_are_cut_at_unique_keys():
    one = [f"k{i}" if i % 3 else "p" for i in range(3000)]
    other = [k for i, k in enumerate(one) if i % 7]
    pairs = wrappers.matched(one, other)
    assert all(one[i] == other[j] for i, j in pairs) and len(pairs) > 0.95 * len(other)
    assert all(a < c and b < d for (a, b), (c, d) in zip(pairs, pairs[1:]))
    assert wrappers.matched(["p"] * 900 + ["q"], ["r"] + ["s"] * 900) == []


def test_a_wrapper_beyond_its_size_keeps_the_weight_of_text():
    page = "".join(f'<div class="c"><b>{i}</b><i{i % 7}>text {i}</i{i % 7}></div><u{i}>' for i in range(3000))
    nodes = wrappers.nodes_of(page)
    whole = wrappers.wrapped(page)
    kept = sum(n.chars for n, _ in wrappers.texts_in(whole.nodes)) + sum(whole.loose.values())
    assert len(whole.nodes) <= wrappers.LONGEST_WRAPPER and kept == sum(n.chars for n in nodes)


def test_clashing_columns_and_a_very_long_page(spark, prose):
    long = "<article>" + "".join(f"<p>{prose(i, 20)}</p>" for i in range(5000)) + "</article>"
    rows = [(1, "http://a/", long, "x"), (2, "http://a/", "<article>b</article>", None)]
    table = spark.createDataFrame(rows, PAGES + ", host string").withColumnRenamed("host", "rank")
    found = {r.page_id: r.text for r in wrappers.main_texts(table).collect()}
    assert found == {1: " ".join(prose(i, 20) for i in range(5000)), 2: "b"}


def test_wrapper_has_slots_options_and_groups():
    pages = [page("<h1>A</h1>" + f"<p>{t}</p>" * n, "Home") for t, n in (("x", 1), ("y", 3), ("z", 2))]
    pages.append(page("<h1>B</h1><p>q</p><hr><p>r</p>", "Home"))
    nodes = wrappers.wrapper_of(pages)
    assert any(isinstance(n.key, tuple) and n.key[1] == "p" and n.group[1].text is None for n in nodes)
    assert any(n.optional and n.key == "hr" for n in nodes)
    assert any(n.key == "" and n.text == "© me" and not n.optional for n in wrappers.nodes_of(pages[0]))


def test_odd_pages(spark):
    rows = [
        (None, None, None), (1, "", ""), (1, "", ""), (2, "no url", "just text &amp; more"), (3, "http://a/", "<p>open <b>tags <i>only"),
        (4, "http://a/", "<script>never closed"), (5, "http://a/", "<div " * 50), (6, "http://b/", "<div>" * 5000 + "deep" + "</div>" * 5000),
        (7, "http://b/", "</p></div>x < y & z &unknown; &#x41;"),
    ]
    found = {r.page_id: r.text for r in wrappers.main_texts(spark.createDataFrame(rows, PAGES)).collect()}
    assert found[None] == found[1] == found[4] == "" and found[2] == "just text & more" and found[3] == "open tags only"
    assert found[6] == "deep" and found[7] == "x < y & z &unknown; A"
    assert wrappers.main_texts(spark.createDataFrame(rows, PAGES)).count() == len(rows)
    assert wrappers.main_texts(spark.createDataFrame([], PAGES)).count() == 0


def archived(spark):
    same, other = "<p>same</p>" * 20, "<p>ü</p>\r\n\r\n" * 30
    rows = [(i, f"http://h/{i}\r\n", same if i % 3 else other + str(i % 2)) for i in range(40, 0, -1)]
    rows += [(50, None, None), (51, "u", ""), (None, "u", same), (7, "http://h/7", same), (52, "u", "short"), (53, "u", "short")]
    return spark.createDataFrame(rows, PAGES), rows


def test_archives_round_trip(spark, monkeypatch):
    table, rows = archived(spark)
    found = warc.read(warc.write(table)).collect()
    assert len(found) == len(rows)
    bytes_of = lambda r: (r[2] or "").encode()
    first: dict[bytes, int] = {}
    for r in rows:
        if r[0] is not None and len(bytes_of(r)) >= 100:
            first[bytes_of(r)] = min(first.get(bytes_of(r), 99), r[0])
    expected = []
    for r in rows:
        to = first.get(bytes_of(r))
        again = to is not None and to != r[0]
        expected.append((str(r[0]), len(bytes_of(r)), hashlib.sha256(bytes_of(r)).hexdigest(), "revisit" if again else "response", str(to if again else None)))
    assert sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, str(r.refers_to)) for r in found) == sorted(expected)
    assert all(r.payload is None for r in found if r.record_type == "revisit")
    assert warc.read(warc.write(table.limit(0))).count() == 0


def test_one_record_by_address(spark):
    table, rows = archived(spark)
    index = warc.write(table).where("page_id = 3")
    assert bytes(warc.fetch(index).first().payload).decode() == dict((r[0], r[2]) for r in rows)[3]


def test_archive_is_plain_zstandard_with_a_seek_table(spark):
    table, _ = archived(spark)
    index = warc.write(table).collect()
    with shared_files.reading(index[0].path) as data:
        frames = warc.frames_of(data)
        data.seek(0)
        whole = data.read()
    records = list(warc.split(b"".join(zstandard.ZstdDecompressor().decompress(whole[a : a + n]) for a, n, _ in frames)))
    assert len(records) == sum(r.path == index[0].path for r in index)
    assert whole.endswith((0x8F92EAB1).to_bytes(4, "little")) and all(r.startswith(b"WARC/1.1\r\n") for r in records)
