"""HTML extraction, license scan and archive fixity."""

import edge_cases
from pyspark.sql import functions as F

from lapse.llm import html_text, license_scan, warc_fixity

ROWS = edge_cases.edge_rows()


def lines(html):
    return [t for t, role in html_text.page_lines(html) if role != html_text.BOILERPLATE]


def test_markup_roles():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><article>x</article>";</script></head><body>
    <header>Site</header><nav><ul><li>Menu</li></ul></nav><div class="cookie-notice">We use cookies</div><aside>Side</aside>
    <article class="post has-sidebar"><h1>Head &amp; more</h1><p>One <b>bold</b> &#x41; a<br>b<p>Two &copy; &lt;tag&gt;
    <div class="ad banner">Buy</div><form>Name <input> <button>Go</button></form><ul><li>x</li><li>y</li></ul>
    <table><tr><td>1</td><td>2</td></tr></table><section id="comments"><p>Nice!</p></section><footer>By me</footer></article>
    <p>outside</p><!-- note <p>no</p> --><footer>&copy; Site</footer></body></html>"""
    got = html_text.page_lines(page)
    assert [t for t, role in got if role == html_text.ARTICLE] == ["Head & more", "One bold A a b", "Two © <tag>", "x", "y", "1 2"]
    assert ("outside", html_text.OPEN) in got
    assert html_text.page_lines(None) == html_text.page_lines("") == []
    assert lines("<p>cut <b>off</b> &amp") == ["cut off &"] and lines("plain < text") == ["plain < text"]
    assert lines("<p title='a > b'>q</p><script>x") == ["q"]


def test_shared_lines_are_a_longest_common_subsequence():
    import random

    r = random.Random(5)
    for _ in range(60):
        a, b = [r.randrange(5) for _ in range(r.randrange(15))], [r.randrange(5) for _ in range(r.randrange(15))]
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        got = html_text.shared_lines(a, b)
        it = iter(b)
        assert len(got) == t[-1][-1] and got == sorted(set(got)) and all(a[i] in it for i in got)


def site(spark):
    rows = []
    for i in range(60):
        body = f"<div>Shop of all things</div><div>Log in</div><p>own text {i} \n here</p><p>more &amp; more {i}</p><div>Imprint</div>"
        rows.append((i, f"https://A.example/{'x' if i % 2 else 'y'}/{i}?q={i}", f"<html><body>{body}</body></html>"))
    rows += [(100, rows[3][1], rows[3][2]), (101, None, None), (102, "nonsense", "<p>alone</p>"), (None, "http://b.example/", "<p>b</p><p>c</p>"),
             (103, "http://c.example/1", "<article><p>kept</p><p>Imprint</p></article><p>Imprint</p>"),
             (104, "http://c.example/2", "<article><p>also</p><p>Imprint</p></article><p>Imprint</p>"),
             (105, "http://d.example/1", "<p>copy</p>"), (106, "http://d.example/2", "<p>copy</p>")]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_nearest_url_differencing(spark):
    got = {r.page_id: (r.text, r.n_chars) for r in html_text.main_text(site(spark).withColumn("host", F.lit(1)).withColumn("text", F.lit("t"))).collect()}
    for i in range(60):
        text = f"own text {i} here\nmore & more {i}"
        assert got[i] == (text, len(text))
    assert got[100] == got[3] and got[101] == ("", 0) and got[102][0] == "alone" and got[None][0] == "b\nc"
    assert got[103][0] == "kept\nImprint" and got[104][0] == "also\nImprint"
    assert got[105][0] == got[106][0] == "copy"
    assert html_text.main_text(site(spark).limit(0)).count() == 0


def test_open_lines_beside_an_article_and_named_sections(spark):
    def page(i, teaser="<article><p>Teaser</p></article>"):
        return f"<div>Shop of things</div><div>own text {i} of this page</p><p>more of it {i}</p></div>{teaser}<div>Imprint</div>"

    rows = [(i, f"http://e.example/{i}", page(i)) for i in range(4)] + [
        (10, "http://e.example/10", page(10, "<article>One</article><article>Two</article>")),
        (20, "http://f.example/", "<article><h2 id='related-work'>Related</h2><p id='notice'>a</p><section id='tracking'><p>b</p></section>"
                                  "<section id='comments'>c</section><div id='sidebar'>d</div></article>")]
    got = {r.page_id: r.text for r in html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(4):
        assert got[i] == f"own text {i} of this page\nmore of it {i}\nTeaser"
    assert got[10] == "own text 10 of this page\nmore of it 10\nOne\nTwo" and got[20] == "Related\na\nb"


def test_neighbours_cross_partition_edges(spark):
    df = spark.createDataFrame([(f"h{i % 3}", i) for i in range(200)], "g string, k int")
    got = {(r.g, r.k): (r.before, r.after) for r in html_text.neighbours(df, ["g", "k"], F.col("k"), "g").collect()}
    for i in range(200):
        assert got[f"h{i % 3}", i] == (i - 3 if i >= 3 else None, i + 3 if i < 197 else None)


def test_license_statements_and_notices(spark, clashing, empty):
    mit = license_scan.TEMPLATES[2][1]
    wrapped = "\n".join(mit[i:i + 80] for i in range(0, len(mit), 80))
    rows = [(1, "some prose here\nReleased under the MIT License.\nmore prose"), (2, f"Copyright 2020 A. Person\n\n{wrapped}\n\nint main;"),
            (3, "a licence to kill is no license for this text at all, whatever it says"), (4, edge_cases.prose(1, 500)),
            (5, "x\nLicensed under the Apache License, Version 2.1."), (6, "This work is licenced under the GNU General Public License, version 2."), (7, None)]
    got = license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = {(r.doc_id, r.license): r for r in got}
    assert found[1, "MIT"].exact and found[1, "MIT"].offset == 16
    assert any(r.doc_id == 2 and r.license == "MIT" and r.kept > 0.9 for r in got)
    assert not [r for r in got if r.doc_id in (3, 4, 7)]
    assert not found[5, "Apache-2.0"].exact and {"-2.0", "+2.1"} == set(found[5, "Apache-2.0"].differences)
    assert not found[6, "GPL-2.0"].exact
    assert license_scan.scan(clashing).count() == license_scan.scan(empty).count() == 0


def test_every_statement_line_of_the_table_is_found(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {(r.doc_id, r.license) for r in license_scan.scan(docs).collect()}
    names = {"Released under the MIT License.": "MIT", "Licensed under the Apache License, Version 2.0.": "Apache-2.0", "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
             "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0"}
    want = {(r.doc_id, n) for r in docs.collect() for line, n in names.items() if line in (r.text or "")}
    assert want and want <= got


def test_statements_inside_long_lines(spark):
    names = dict((text, name) for name, text in license_scan.TEMPLATES)
    before = " ".join(edge_cases.prose(3, 500).replace(".", " ").split())  # no sentence marks
    rows = [(i, f"{before[:k]} {t} {before[:k]}") for i, (t, k) in enumerate((t, k) for t in names for k in (40, 300, 2000))]
    both = "Licensed under CC BY 4.0."
    rows += [(1000, f"{before[:90]} {both} and {before[:400]} {both} {before}"), (1001, before),
             (1002, "This Source Code Form is subject to the terms of the\n" + license_scan.TEMPLATES[9][1].split("terms of the ")[1])]
    got = license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = {(i, names[t], len(before[:k]) + 1) for i, (t, k) in enumerate((t, k) for t in names for k in (40, 300, 2000))}
    assert {(r.doc_id, r.license, r.offset) for r in got if r.exact and r.doc_id < 1000} == want
    assert [(r.offset, r.block) for r in got if r.doc_id == 1000] == [(91, both), (91 + len(both) + 5 + 401, both)]
    assert not [r for r in got if r.doc_id == 1001] and [(r.license, r.exact) for r in got if r.doc_id == 1002] == [("MPL-2.0", True)]


def manifest(spark, n=4000, change=None):
    rows, at = [], {}
    for i in range(n):
        f = f"f{i % 37}"
        rows.append([f, at.get(f, 0), 300 + i % 50, f"digest{i}"])
        at[f] = at.get(f, 0) + 300 + i % 50
    return rows


def test_audit_finds_exactly_the_damage(spark):
    kind = "file string, offset long, length long, sha256 string"
    rows = manifest(spark)
    mine = spark.createDataFrame(rows, kind)
    assert warc_fixity.audit(mine, mine).count() == 0
    copy = [list(r) for r in rows]
    copy[17][3] = "flipped"
    copy[1500][2] += 1
    lost, extra = copy.pop(3000), ["f99", 0, 1, "new"]
    other = spark.createDataFrame([*copy, extra], kind)
    got = {(r.file, r.offset): (r.mine, r.other) for r in warc_fixity.audit(mine, other).collect()}
    assert got == {
        (rows[17][0], rows[17][1]): (f"{rows[17][2]}:digest17", f"{rows[17][2]}:flipped"),
        (rows[1500][0], rows[1500][1]): (f"{rows[1500][2]}:digest1500", f"{rows[1500][2] + 1}:digest1500"),
        (lost[0], lost[1]): (f"{lost[2]}:digest3000", None), ("f99", 0): (None, "1:new")}
    assert warc_fixity.audit(mine, mine.limit(0)).count() == len(rows)
    assert warc_fixity.audit(mine.limit(0), mine.limit(0)).count() == 0


def test_archive_offsets_are_running_lengths(spark):
    pages = site(spark).union(site(spark).limit(1)).withColumn("length", F.lit(0))
    rows = warc_fixity.archive(pages, file_records=4).collect()
    assert len(rows) == pages.count()
    files = {}
    for r in sorted(rows, key=lambda r: (r.file, r.offset)):
        assert r.offset == files.get(r.file, 0)
        files[r.file] = r.offset + r.length
    assert len(files) > 4 and warc_fixity.archive(pages.limit(0)).count() == 0


def brute_main_text(pages):
    """{url: text} of pages of different paths: each page's lines outside articles against those of the nearest path."""
    def alike(a, b):
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        return n

    def lcs(a, b):
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a) - 1, -1, -1):
            for j in range(len(b) - 1, -1, -1):
                t[i][j] = t[i + 1][j + 1] + 1 if a[i] == b[j] else max(t[i + 1][j], t[i][j + 1])
        out, i, j = set(), 0, 0
        while i < len(a) and j < len(b):
            if a[i] == b[j]:
                out.add(i)
                i, j = i + 1, j + 1
            elif t[i + 1][j] >= t[i][j + 1]:
                i += 1
            else:
                j += 1
        return out

    out, hosts = {}, {}
    for url, source in pages:
        host, _, path = url.removeprefix("https://").partition("/")
        hosts.setdefault(host, []).append(("/" + path, url, html_text.page_lines(source)))
    for rows in hosts.values():
        rows.sort()
        framed = [r for r in rows if any(k != html_text.ARTICLE for _, k in r[2])]
        for path, url, lines in rows:
            frame = [i for i, (_, k) in enumerate(lines) if k != html_text.ARTICLE]
            gone = {i for i in frame if lines[i][1] == html_text.BOILERPLATE}
            if frame:
                n = [r[1] for r in framed].index(url)
                before, after = framed[n - 1] if n else None, framed[n + 1] if n + 1 < len(framed) else None
                pair = max((p for p in (before, after) if p), key=lambda p: alike(path, p[0]), default=None)
                if pair:
                    shared = {frame[i] for i in lcs([lines[i][0] for i in frame], [t for t, k in pair[2] if k != html_text.ARTICLE])}
                    opened = {i for i in frame if lines[i][1] == html_text.OPEN}
                    article = [[t for t, k in x if k == html_text.ARTICLE] for x in (lines, pair[2])]
                    if not (opened <= shared and (not article[0] or article[0] == article[1])):
                        gone |= shared
            out[url] = "\n".join(t for i, (t, _) in enumerate(lines) if i not in gone)
    return out


def test_open_lines_beside_a_longer_article_stay(spark):
    def page(n):
        return (f"https://h.example/news/{n}", f"<nav>menu</nav><p>Our site, since 1999</p><p>Opening words of story {n}.</p><article>"
                + "".join(f"<p>Paragraph {k} of story {n}, which is long enough.</p>" for k in range(6))
                + f"</article><p>Closing words of story {n}.</p><p>All rights kept</p><footer>f</footer>")

    rows = [page(n) for n in range(3)] + [("https://h.example/alone", "<p>only open</p>"), ("https://other.example/x", page(7)[1])]
    df = spark.createDataFrame([(n, u, h) for n, (u, h) in enumerate(rows)], "page_id long, url string, html string")
    got = {r.url: r.text for r in html_text.main_text(df).collect()}
    assert got == brute_main_text(rows)
    for n in range(3):
        lines = got[f"https://h.example/news/{n}"].split("\n")
        assert lines[0] == f"Opening words of story {n}." and lines[-1] == f"Closing words of story {n}." and len(lines) == 8


def test_main_text_against_brute_force(spark):
    import random
    r = random.Random(12)
    site = [f"site line {k}" for k in range(6)]
    rows = []
    for n in range(120):
        host, body, used = f"h{n % 4}.example", [], set()  # a line occurs once in a page: the alignment is then unique
        for k in range(r.randint(0, 9)):
            kind = r.random()
            text = r.choice(site) if kind < 0.5 else f"own line {n} {k}"
            if text in used:
                continue
            used.add(text)
            body.append({0: f"<p>{text}</p>", 1: f"<div>{text}</div>", 2: f"<nav>{text}</nav>", 3: f"<article><p>{text}</p></article>",
                         4: f"<div class='ad'>{text}</div>"}[r.choice([0, 0, 0, 1, 2, 3, 3, 4])])
        body.sort(key=lambda x: [i for i, s in enumerate(site) if s in x] or [3])  # the site's lines stand in the same order
        rows.append((f"https://{host}/{r.choice(['a', 'ab', 'b/c'])}/{n}", "".join(body)))
    df = spark.createDataFrame([(n, u, h) for n, (u, h) in enumerate(rows)], "page_id long, url string, html string")
    want = brute_main_text(rows)
    got = {x.url: x.text for x in html_text.main_text(df).collect()}
    assert got == want
    assert any(s in h and s not in want[u] for u, h in rows for s in site)


def test_every_given_page_is_aligned_with_its_neighbour(spark):
    """The lines outside articles of all given pages go through the alignment, and pages of a site do share some."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").orderBy("url").collect()
    frames = [html_text.parts_of(p.html)[2] for p in pages]
    assert all(frames) and any(html_text.shared_lines(a, b) for a, b in zip(frames, frames[1:]))


def test_very_long_pages(spark):
    long = "<article>" + "".join(f"<p>line {k}</p>" for k in range(60_000)) + "</article><p>after</p>"
    df = spark.createDataFrame([(1, "https://h.example/a", long), (2, "https://h.example/b", long.replace("after", "behind")), (3, None, None)],
                               "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_text.main_text(df).collect()}
    assert got[1].endswith("line 59999\nafter") and got[2].endswith("\nbehind") and got[3] == "" and got[1].count("\n") == 60_000
