from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from skyledger.functions.text import is_valid_email, strip_space, words
from skyledger.operators.chunking import chunk_by_section, flatten_elements
from skyledger.sources.documents import parse_documents, parse_html, parse_json_documents, rejected_documents, scan_documents
from skyledger.sources.files import make_folder, write_each

ELEMENTS = "source_document string, element_id int, element_type string, content string"
HEADINGS = ("title", "section_header")


def brute_chunks(rows, max_words):
    """Chunks of each document, element by element."""
    found = []
    for document in {row[0] for row in rows}:
        section, pending, position = "Untitled", [], 0

        def close():
            nonlocal position
            for start in range(0, len(pending), max_words):
                text = " ".join(pending[start:start + max_words])
                found.append((f"{document}::chunk_{position}", document, position, section, text))
                position += 1

        for _, _, kind, content in sorted((r for r in rows if r[0] == document), key=lambda r: r[1]):
            if kind in HEADINGS:
                close()
                pending = []
                section = (content or "").strip() or section
            else:
                pending += (content or "").split()
        close()
    return sorted(found)


def chunks(spark, rows, max_words=1200, block_elements=4096):
    df = chunk_by_section(spark.createDataFrame(rows, ELEMENTS).repartition(5), max_words, block_elements)
    return sorted(tuple(row) for row in df.collect())


@pytest.mark.parametrize("max_words,block_elements", [(1, 1), (3, 2), (7, 5), (50, 3), (4, 1000)])
def test_chunks_match_brute_force(spark, max_words, block_elements):
    draw = random.Random(max_words * 100 + block_elements)
    rows = []
    for document in range(12):
        ids = sorted(draw.sample(range(200), 60))
        for element_id in ids:
            kind = draw.choice(["text", "text", "text", "caption", "table", "title", "section_header"])
            if kind in HEADINGS:
                content = draw.choice([f"head {element_id}", "  ", None, " named "])
            else:
                content = draw.choice([None, "", " \t\n", " ".join(f"w{element_id}_{i}" for i in range(draw.randrange(12)))])
            rows.append((f"doc{document}", element_id, kind, content))
    assert chunks(spark, rows, max_words, block_elements) == brute_chunks(rows, max_words)


def test_chunk_edges(spark):
    cap = " ".join(f"w{i}" for i in range(11))
    rows = [
        ("headings only", 0, "title", "A"), ("headings only", 1, "section_header", "B"),
        ("no heading", 0, "text", "one two\x1cthree"),
        ("over the cap", 0, "title", "T"), ("over the cap", 1, "text", cap),
        ("blank heading", 0, "title", "Kept"), ("blank heading", 1, "text", "a"),
        ("blank heading", 2, "section_header", " "), ("blank heading", 3, "text", "b"),
    ]
    found = chunks(spark, rows, 10)
    assert found == brute_chunks(rows, 10)
    assert [(c[1], c[2], c[3], c[4]) for c in found] == [
        ("blank heading", 0, "Kept", "a"), ("blank heading", 1, "Kept", "b"),
        ("no heading", 0, "Untitled", "one two three"),
        ("over the cap", 0, "T", cap[:-4]), ("over the cap", 1, "T", "w10"),
    ]


def test_one_document_with_most_rows(spark):
    rows = [("hot", i, "section_header" if i % 50 == 7 else "text", f"w{i} x") for i in range(3000)]
    rows += [(f"d{i}", 0, "text", "only") for i in range(20)]
    assert chunks(spark, rows, 30, 64) == brute_chunks(rows, 30)


def test_empty_elements_give_no_chunks(spark):
    df = chunk_by_section(spark.createDataFrame([], ELEMENTS))
    assert df.count() == 0
    assert df.dtypes == [
        ("chunk_id", "string"), ("source_document", "string"), ("chunk_position", "int"), ("section", "string"), ("chunk_text", "string"),
    ]


def test_flatten_keeps_content_types(spark, tmp_path):
    elements = [
        {"id": 0, "type": "title", "content": "T"}, {"id": 1, "type": "page_header", "content": "x"},
        {"id": 2, "type": None, "content": "x"}, {"id": 3, "type": "table"}, {"id": "four", "type": "text", "content": "c"},
    ]
    (tmp_path / "a.json").write_text(json.dumps({"document": {"elements": elements}}))
    (tmp_path / "b.json").write_text('{"document":{"elements":[]}}')
    (tmp_path / "c.json").write_text('{"document":{"elements":null}}')
    (tmp_path / "d.json").write_text("{bad")
    rows = flatten_elements(parse_json_documents(scan_documents(spark, str(tmp_path)))).collect()
    assert all(row.source_document.endswith("/a.json") for row in rows)
    assert sorted([(row.element_id, row.element_type, row.content) for row in rows], key=repr) == [
        (0, "title", "T"), (3, "table", None), (None, "text", "c"),
    ]


def test_html_elements(spark):
    html = (
        '<!DOCTYPE html><html><head><title>Page</title><style>p{}</style><script>var t="</p>";</script></head><body>'
        "<nav><ul><li>Home</li></ul></nav><h1>Big &amp; bold</h1><p>First<br>line<p>Second <b>part</b>"
        "<h3>Sub</h3><ul><li>one<li>two</ul><table><caption>Fees</caption><tr><td>a</td><td>b</td></tr></table>"
        "<div>loose</div><!-- note --><footer>Foot<p>er</footer></body></html>"
    )
    pages = spark.createDataFrame([("p", html), ("empty", ""), ("none", None)], "path string, html string")
    parsed = parse_html(pages)
    rows = parsed.select("path", F.expr("CAST(parsed:document:elements AS ARRAY<STRUCT<id INT, type STRING, content STRING>>)").alias("e"))
    found = {row.path: [tuple(e) for e in row.e] for row in rows.collect()}
    assert found["empty"] == found["none"] == []
    assert [e[1:] for e in found["p"]] == [
        ("title", "Page"), ("page_header", "Home"), ("title", "Big & bold"), ("text", "First line"), ("text", "Second part"),
        ("section_header", "Sub"), ("text", "one"), ("text", "two"), ("caption", "Fees"), ("table", "a b"), ("text", "loose"),
        ("page_footer", "Foot"), ("page_footer", "er"),
    ]
    assert [e[0] for e in found["p"]] == list(range(13))
    assert flatten_elements(parsed).count() == 10


def test_a_folder_of_documents(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"document":{"elements":[{"id":0,"type":"text","content":"from json"}]}}')
    (tmp_path / "b.html").write_text("<h1>Tïtle</h1><p>from html")
    (tmp_path / "c.htm").write_text("<p>")
    (tmp_path / "d.bin").write_bytes(b"\x00\xff")
    assert scan_documents(spark, str(tmp_path)).count() == 4
    parsed = parse_documents(spark, str(tmp_path))
    assert parsed.count() == 3
    found = {(r.source_document.rsplit("/", 1)[1], r.content) for r in flatten_elements(parsed).collect()}
    assert found == {("a.json", "from json"), ("b.html", "Tïtle"), ("b.html", "from html")}


def test_words_split_like_unicode_text(spark):
    texts = ["a b", "  a b c\x1dd\n", "", None, "　", "x​y"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", words(F.col("t")).alias("w"), strip_space(F.col("t")).alias("s")).collect()
    for row in rows:
        assert row.w == (row.t or "").split()
        assert row.s == (None if row.t is None else row.t.strip())


def test_email(spark):
    valid = ["a@b.co", "A.b+c%d-e_f@x-y.z.org", "a@b.com\n"]
    invalid = [None, "", "a@b", "a@b.c", "a b@c.com", "a@b.com\n\n", "@b.com", "a@b.c0m", " a@b.com"]
    df = spark.createDataFrame([(e, e in valid) for e in valid + invalid], "email string, wanted boolean")
    assert df.filter(is_valid_email(F.col("email")) != F.col("wanted")).count() == 0


def test_elements_without_usable_ids_keep_their_order(spark):
    kinds = [("title", "Z head"), ("text", "zebra first"), ("text", "apple second"), ("section_header", "A next"), ("text", "mango third")]
    for ids in ([None] * 5, [4] * 5, ["x", "y", "x", None, "z"]):
        elements = [{"id": id, "type": kind, "content": content} for id, (kind, content) in zip(ids, kinds)]
        parsed = parse_json_documents(spark.createDataFrame([("d", json.dumps({"document": {"elements": elements}}))], "path string, content string"))
        found = chunk_by_section(flatten_elements(parsed), 100, 2).orderBy("chunk_position").collect()
        assert [(row.section, row.chunk_text) for row in found] == [("Z head", "zebra first apple second"), ("A next", "mango third")]


def test_long_document_without_ids(spark):
    elements = [{"type": "section_header" if at % 40 == 9 else "text", "content": f"w{at} x"} for at in range(5000)]
    parsed = parse_json_documents(spark.createDataFrame([("d", json.dumps({"document": {"elements": elements}}))], "path string, content string"))
    rows = [("d", at, one["type"], one["content"]) for at, one in enumerate(elements)]
    found = sorted(tuple(row) for row in chunk_by_section(flatten_elements(parsed), 30, 64).collect())
    assert found == brute_chunks(rows, 30)


def test_rejected_documents_account_for_the_scan(spark, tmp_path):
    texts = {"a.json": '{"document":{"elements":[{"id":0,"type":"text","content":"x"}]}}', "B.JSON": "{bad", "c.json": "{}",
             "d.json": '{"document":{"elements":[]}}', "P.HTML": "<p>hello", "q.htm": " ", "notes.txt": "x"}
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    parsed = parse_documents(spark, str(tmp_path))
    rejected = rejected_documents(scan_documents(spark, str(tmp_path)), parsed)
    found = {row.path.rsplit("/", 1)[1]: (row.length, row.reason) for row in rejected.collect()}
    assert found == {
        "B.JSON": (4, "not read as JSON: broken, or above a limit of the parser"), "c.json": (2, "no list of elements"),
        "d.json": (28, "no elements"), "q.htm": (1, "no elements"), "notes.txt": (1, "unknown file type"),
    }
    accepted = {row.source_document.rsplit("/", 1)[1] for row in flatten_elements(parsed).collect()}
    assert accepted | set(found) == set(texts)


def test_page_above_the_text_limit_of_json(spark):
    word = "word " * (5 << 20)
    pages = spark.createDataFrame([("big", f"<h1>Title</h1><p>{word}</p>"), ("small", "<p>x</p>")], "path string, html string")
    found = {(row.source_document, row.element_type): row.size for row in
             flatten_elements(parse_html(pages)).selectExpr("source_document", "element_type", "length(content) AS size").collect()}
    assert found == {("big", "title"): 5, ("big", "text"): len(word) - 1, ("small", "text"): 1}


def test_open_margins_end_where_content_starts(spark):
    pages = {
        "nav": "<nav>menu<main><h1>Real</h1><p>body</p></main>",
        "unseen": "<noscript>off<article><p>seen</p></article>",
        "header": "<header>site</header><article><header><h1>Title</h1></header><p>x</p></article>",
        "footer": "<p>x</p><footer><section><p>legal</p></section></footer>",
    }
    df = spark.createDataFrame(list(pages.items()), "path string, html string")
    found = {}
    for row in flatten_elements(parse_html(df)).orderBy("source_document", "element_position").collect():
        found.setdefault(row.source_document, []).append((row.element_type, row.content))
    assert found == {
        "nav": [("title", "Real"), ("text", "body")], "unseen": [("text", "seen")],
        "header": [("title", "Title"), ("text", "x")], "footer": [("text", "x")],
    }


def test_each_row_is_written_to_a_file_of_its_own_by_the_tasks(spark, tmp_path):
    folder = make_folder(spark, str(tmp_path / "each"))
    kinds = {0: "txt", 1: "json", 2: "json"}
    rows = [(kinds[n % 3], b"" if n == 5 else b"text %d\n" % n) for n in range(300)]
    write_each(spark.createDataFrame(rows, "extension string, content binary").repartition(5), folder)
    # No digests or leftovers beside them.
    found = [(path.suffix[1:], path.read_bytes()) for path in (tmp_path / "each").iterdir()]
    assert sorted(found) == sorted(rows)
    assert scan_documents(spark, folder, "*.json").filter("length(content) > 0").count() == 199


def test_folders_of_a_pattern_are_listed_and_read_by_tasks(spark, tmp_path):
    rows = [("json" if n % 3 else "HTM", b"" if n % 50 == 7 else b"<p>text %d\n" % n) for n in range(90)]
    make_folder(spark, str(tmp_path / "all" / "none"))
    write_each(spark.createDataFrame(rows, "extension string, content binary").repartition(3), str(tmp_path / "all"), per_folder=8)
    folders = [path for path in (tmp_path / "all").iterdir() if path.name != "none"]
    assert len(folders) >= 12 and max(len(list(path.iterdir())) for path in folders) <= 8
    for name in (".hidden.json", "_hidden.json", "_a=b.json", "with space.json", "late._COPYING_"):
        (folders[0] / name).write_text("x")
    (folders[1] / "below").mkdir()
    (folders[1] / "below" / "deep.json").write_text("x")
    pattern = str(tmp_path / "all" / "*")
    for names in ("*", "*.[jJ][sS][oO][nN]", "*.{[hH][tT][mM][lL],[hH][tT][mM]}", "part-0000[!1]-00000000?-*"):
        wanted = spark.read.format("binaryFile").option("pathGlobFilter", names).load(pattern).select("path", "content").collect()
        found = scan_documents(spark, pattern, names)
        # The driver lists no file.
        assert found.inputFiles() == [] and wanted
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, wanted))
        assert sorted(map(tuple, scan_documents(spark, pattern, names, content=False).collect())) == sorted((row.path, len(row.content)) for row in wanted)
    rejected = rejected_documents(scan_documents(spark, pattern, content=False), parse_documents(spark, pattern))
    again = rejected_documents(scan_documents(spark, pattern), parse_documents(spark, pattern))
    assert sorted(map(tuple, rejected.collect())) == sorted(map(tuple, again.collect()))
    assert rejected.count() == 61 and {len(row) for row in rejected.collect()} == {3}


def test_a_pattern_that_matches_files_is_read_by_spark(spark, tmp_path):
    (tmp_path / "a.json").write_text("{}")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "b.json").write_text("[1]")
    found = scan_documents(spark, str(tmp_path / "*"))
    assert {row.path.rsplit("/", 1)[1] for row in found.collect()} == {"a.json", "b.json"}
    assert [tuple(row)[1] for row in scan_documents(spark, str(tmp_path / "a.json"), content=False).collect()] == [2]
    assert scan_documents(spark, str(tmp_path / "s*")).count() == 1


def test_chunking_reads_its_elements_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    rows = [(f"doc{n % 40}", n // 40, n // 40, "title" if n % 9 == 0 else "text", f"word {n}") for n in range(2000)]
    elements = spark.createDataFrame(rows, "source_document string, element_position int, element_id int, element_type string, content string")
    chunks = chunk_by_section(elements.mapInPandas(count, elements.schema), max_words=7, block_elements=8)
    words_kept = chunks.selectExpr("sum(size(split(chunk_text, ' ')))").first()[0]
    assert words_kept == 2 * sum(row[3] == "text" for row in rows)
    assert seen.value == len(rows)
