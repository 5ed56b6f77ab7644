"""Operators over pages and vectors."""

import gzip

import numpy as np
import pyarrow as pa
from tidelog.llm import ann, html_extract, warc
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def test_extraction_on_held_out_templates():
    field, right, total = html_extract.trained(), 0, 0
    for page in html_extract.labelled_pages(150, seed=99):
        found = html_extract.blocks(page)
        want = [b[0].endswith("\ue000") for b in found]
        got = field.decode(field.scores([(b[0].rstrip("\ue000") or "x", b[1], b[2]) for b in found]))
        right += sum(a == bool(b) for a, b in zip(want, got, strict=True))
        total += len(want)
    assert right >= 0.97 * total


def test_extraction_cases(spark):
    page = "<html><head><title>no</title></head><body><nav><ul><li><a href='/'>menu</a></li></ul></nav><article><h1>A &amp; B</h1><p>One\n two,  three.<p>Four &lt;five&gt;.<script>x('</p>')</script></article><footer>end</footer></body></html>"
    rows = [(1, "u", page, "x"), (2, None, None, None), (3, "", "", "y"), (4, "u", "<nav><ul><li><a href=/>only a menu</a></li></ul></nav>", "z"), (1, "u", page, "x"), (5, "u", "<article><p>cut off in the mid", "z")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = {r.page_id: (r._text, r.n_chars) for r in html_extract.extract(df).collect()}
    want = "A & B\nOne two, three.\nFour <five>."
    assert got == {1: (want, len(want)), 2: ("", 0), 3: ("", 0), 4: ("", 0), 5: ("cut off in the mid", 18)}
    assert html_extract.extract(df.limit(0)).count() == 0


def test_extraction_of_heads_without_end(spark):
    body = "<article><h1>A head</h1><p>One two, three.</p><p>Four five six.</p></article>"
    heads = ["<head><title>t</title>", "<html><head><meta charset=utf-8><title>t</title><style>p{}</style>\n", '<head><link rel=x href="y""><title>t</title></head><body>', "<head><title>t</title></head><body>"]
    df = spark.createDataFrame([(i, h + body) for i, h in enumerate(heads)], "page_id long, html string")
    assert {r.page_id: r.text for r in html_extract.extract(df).collect()} == dict.fromkeys(range(4), "A head\nOne two, three.\nFour five six.")
    assert [b[0] for b in html_extract.blocks("<head><title>t</title> One <b>two</b><p>three")] == ["One two", "three"]


def test_extraction_of_odd_markup():
    texts = lambda page: [b[0] for b in html_extract.blocks(page)]
    assert texts('<article><p>A</p><svg class="icon"/><p>B</p></article>') == ["A", "B"]
    assert texts("<article><p>A</p><button>go<p>B</p><select><option>C<p>D</p>") == ["A", "go", "B", "C", "D"]
    assert texts("<p>A<button>go</button> B<svg><text>x</text></svg></p><noscript><p>C</p></noscript><object><p>D</p></object><canvas>E</canvas>") == ["A B", "C", "D", "E"]
    assert texts("<html><head><title>t</title><p>A</p><p>B</p></html>") == ["A", "B"]
    assert texts('<p class="x"">A</p><p title=y">B</p><p title="a > b">C</p>') == ["A", "B", "C"]
    assert texts("<p>A<script>x('</p>')") == ["A"] and texts("<p>A<!-- x") == ["A"] and texts("<title/>A") == ["A"]
    many = "<div class='" + " ".join("abcdefgh"[i % 8] * (i + 1) for i in range(30)) + "'>x</div>"
    assert len(html_extract.blocks(many)[0][2]) == 31
    assert len(texts("<p>word one, two.</p>" * 20_000 + "<button>" * 5000)) == 20_000


def test_blocks_by_another_parser(spark):
    """The standard library's parser finds the same texts between the same tags."""
    from html.parser import HTMLParser

    class Other(HTMLParser):
        def __init__(self):
            super().__init__()
            self.out, self.held, self.skip = [], [], ""

        def flush(self):
            text = " ".join("".join(self.held).split())
            self.out += [text] if text else []
            self.held = []

        def handle_starttag(self, tag, attrs):
            if tag in html_extract.DROPPED:
                self.skip = self.skip or tag
            elif tag in html_extract.BLOCKS:
                self.flush()
            elif tag in ("br", "img", "input", "wbr"):
                self.held.append(" ")

        def handle_endtag(self, tag):
            if tag == self.skip:
                self.skip = ""
            elif tag in html_extract.BLOCKS:
                self.flush()

        def handle_data(self, data):
            if not self.skip:
                self.held.append(data)

    pages = [r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()] + html_extract.labelled_pages(30, seed=3)
    for page in pages:
        other = Other()
        other.feed(page or "")
        other.close()
        other.flush()
        assert [b[0] for b in html_extract.blocks(page or "")] == other.out


def test_viterbi_and_likelihood_by_enumeration():
    from itertools import product

    field = html_extract.trained()
    rng = np.random.default_rng(1)

    def score(s, ys):
        return field.first[ys[0]] + sum(s[i] * y for i, y in enumerate(ys)) + sum(field.trans[a, b] for a, b in zip(ys, ys[1:], strict=False))

    for n in (1, 2, 5, 9):
        for _ in range(10):
            s = rng.normal(size=n) * 3
            got = tuple(int(y) for y in field.decode(s))
            assert np.isclose(score(s, got), max(score(s, ys) for ys in product((0, 1), repeat=n)))


def test_warc_cases(spark):
    big = "<p>" + "x" * 200 + "\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n</p>"
    rows = [(5, "http://a.example/x?y#z", big), (3, None, big), (3, None, big), (9, "no\r\nurl", big), (7, "u", "short"), (8, "u", "short"), (1, "u", None), (None, "u", ""), (2, "u", "é" * 60)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("x"))
    got = warc.round_trip(df).collect()
    assert len(got) == len(rows)
    own = sorted((r.page_id or 0, r.record_type, r.refers_to) for r in got)
    assert own == [(0, "response", None), (1, "response", None), (2, "response", None), (3, "response", None), (3, "revisit", 3), (5, "revisit", 3), (7, "response", None), (8, "response", None), (9, "revisit", 3)]
    assert {r.payload_bytes for r in got if r.page_id in (3, 5, 9)} == {len(big)} and {r.payload_bytes for r in got if r.page_id == 2} == {120}
    assert warc.round_trip(df.limit(0)).count() == 0


def test_warc_rows_without_id(spark):
    big, other = "<p>" + "y" * 300, "<p>\r\n\r\n\r\n" + "z" * 300 + "\r\n\r\n"
    rows = [(5, "u", big), (None, "u", big), (None, "v", big), (None, "a", other), (None, "b", other), (None, "a", other), (4, "w", "x" * 99), (None, "w", "x" * 99)]
    got = warc.round_trip(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted((r.page_id or 0, r.record_type, r.refers_to or 0) for r in got if r.payload_bytes == len(big)) == [(0, "revisit", 5), (0, "revisit", 5), (5, "response", 0)]
    assert sorted((r.record_type, r.refers_to) for r in got if r.payload_bytes == len(other)) == [("response", None), ("revisit", None), ("revisit", None)]
    assert [r.record_type for r in got if r.payload_bytes == 99] == ["response"] * 2


def test_warc_of_long_pages(spark, tmp_path):
    pages = {1: "é\r\n\r\n" * 1_500_000, 2: "", 3: "\r\n\r\n", 4: "WARC/1.1\r\n\r\nx"}
    path = str(tmp_path / "w")
    warc.write(spark.createDataFrame(list(pages.items()), "page_id long, html string").selectExpr("*", "cast(null as string) url").coalesce(1), path)
    got = warc.assemble(warc.read(spark, path)).collect()
    assert {int(r.metadata.fields["page-id"]): bytes(r.response.payload).decode() for r in got} == pages


def test_warc_records(spark, tmp_path):
    df = spark.read.parquet(f"{SF}/pages.parquet").limit(20)
    path = str(tmp_path / "w")
    warc.write(df, path)
    captures = warc.assemble(warc.read(spark, path)).collect()
    html = {r.page_id: r.html for r in df.collect()}
    assert len(captures) == 20
    for c in captures:
        assert c.request.fields[""].startswith("GET /") and bytes(c.response.payload).decode() == html[int(c.metadata.fields["page-id"])]
    one = next((tmp_path / "w").glob("*.gz"))
    assert gzip.decompress(one.read_bytes()).startswith(b"WARC/1.1\r\nWARC-Type: request")


def test_ann_recall(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = df.collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    got: dict[int, list] = {}
    for r in ann.search(df, "vec_id", "embedding", F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r.query_id, []).append(r)
    hit = total = 0
    for i in np.flatnonzero(ids % 20 == 0):
        s = x @ x[i]
        want = [ids[j] for j in np.lexsort((ids, -s)) if j != i][:20]
        own = sorted(got[ids[i]], key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == list(range(1, len(own) + 1)) and all(np.isclose(r.score, s[ids == r.vec_id][0]) for r in own)
        hit += len({r.vec_id for r in own} & set(want))
        total += len(want)
    assert hit >= 0.9 * total


def test_ann_recall_of_many_clustered_vectors(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 64))
    x = (centres / np.linalg.norm(centres, axis=1)[:, None])[rng.integers(0, 40, 40_000)] + rng.normal(size=(40_000, 64)) * 0.06
    x /= np.linalg.norm(x, axis=1)[:, None]
    df = spark.createDataFrame(pa.table({"vec_id": np.arange(40_000), "embedding": pa.array(list(x))}))
    got: dict[int, set] = {}
    for r in ann.search(df, "vec_id", "embedding", F.col("vec_id") % 400 == 0).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert sorted(got) == list(range(0, 40_000, 400))
    hit = 0
    for i in got:
        s = x @ x[i]
        s[i] = -np.inf
        hit += len(got[i] & set(np.argpartition(-s, 20)[:20].tolist()))
    assert hit >= 0.98 * 20 * len(got)


def test_ann_cases(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [float(i % 3), 1.0]) for i in range(60)]
    bad = [(100, None), (120, [nan, 1.0]), (140, [inf, 1.0]), (160, [0.0, 0.0]), (180, []), (200, [1.0]), (220, [None, 1.0]), (None, [1.0, 1.0])]
    df = spark.createDataFrame(good + bad, "vec_id long, embedding array<float>")
    got = ann.search(df, "vec_id", "embedding", F.col("vec_id") % 20 == 0, k=5).collect()
    assert {r.query_id for r in got} == {0, 20, 40} and all(r.vec_id < 60 for r in got)
    assert [r.vec_id for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == 20] == [2, 5, 8, 11, 14]
    assert ann.search(df.limit(0), "vec_id", "embedding", F.lit(True)).count() == 0
    twice = ann.search(df.unionByName(df), "vec_id", "embedding", F.col("vec_id") % 20 == 0, k=5).collect()
    assert sorted(twice) == sorted(got)
    lengths = spark.createDataFrame([(i, [float(i)] * (1 + i % 2)) for i in range(1, 9)], "vec_id long, embedding array<float>")
    assert {(r.query_id, r.vec_id) for r in ann.search(lengths, "vec_id", "embedding", F.col("vec_id") <= 2).collect()} == {(1, 3), (1, 5), (1, 7), (2, 4), (2, 6), (2, 8)}
    few = ann.search(df.filter("vec_id < 3"), "vec_id", "embedding", F.lit(True)).collect()
    assert len(few) == 6
