import pytest
from pyspark.sql import functions as F

from freshet.config import JobConfig
from freshet.functions.windows import windows, windows_by_column
from freshet.operators import chunking as ch
from freshet.operators.extras import html_blocks, json_object_pieces
from freshet.operators.routing import extractor_name, identify, select_markdown_files
from freshet.operators.tabular import chunk_rows


def texts(spark, values):
    rows = list(enumerate(values))
    return spark.createDataFrame(rows, "i INT, text STRING").repartition(1).orderBy("i")


def by_row(df):
    return [r[1] for r in sorted(df.collect())]


# Text, size, overlap and the windows, written out.
WINDOW_CASES = [
    ("x" * 1049, 1200, 150, ["x" * 1049]),
    ("x" * 1050, 1200, 150, ["x" * 1050]),
    ("x" * 1051, 1200, 150, ["x" * 1051, "x"]),
    ("x" * 1100, 1200, 150, ["x" * 1100, "x" * 50]),
    ("\U0001f600" * 1300, 1200, 150, ["\U0001f600" * 1200, "\U0001f600" * 250]),
    ("a" + " " * 2500 + "b", 1200, 150, ["a" + " " * 1199, " " * 401 + "b"]),
    (" x\x1c", 1200, 150, ["x"]),
    ("", 1200, 150, []),
    (" \u3000 ", 5, 1, []),
    (" line\x85", 3, 1, ["lin", "ne"]),
    ("abcdef", 0, 10, ["abcdef"]),
    ("abcd", 3, 3, ["abc", "bcd", "cd", "d"]),
    ("abcd", 3, 7, ["abc", "bcd", "cd", "d"]),
    ("abcdefg", 3, 0, ["abc", "def", "g"]),
    ("ab      cd", 2, 0, ["ab", "cd"]),
]


def test_windows(spark):
    rows = [(i, *c[:3]) for i, c in enumerate(WINDOW_CASES)]
    df = spark.createDataFrame(rows, "i INT, text STRING, size INT, overlap INT")
    expected = [c[3] for c in WINDOW_CASES]
    assert by_row(df.select("i", windows_by_column(F.col("text"), F.col("size"), F.col("overlap")))) == expected
    for size, overlap in {c[1:3] for c in WINDOW_CASES}:
        same = df.where((F.col("size") == size) & (F.col("overlap") == overlap))
        got = by_row(same.select("i", windows(F.col("text"), size, overlap)))
        assert got == [c[3] for c in WINDOW_CASES if c[1:3] == (size, overlap)]


@pytest.mark.parametrize("size,overlap", [(400, 0), (512, 64), (1200, 150)])
def test_windows_overlap_and_cover_the_text(spark, size, overlap):
    text = "\xe9\U0001f600" * 900 + "\n\n" + "z" * 700
    (found,) = by_row(texts(spark, [text]).select("i", windows(F.col("text"), size, overlap)))
    full = [w for w in found if len(w) == size]
    assert full and found[: len(full)] == full
    if overlap:
        assert all(b.startswith(a[-overlap:][: len(b)]) for a, b in zip(full, found[1:]))
    assert "".join(w[: size - overlap] for w in found)[: len(text)] == text


def test_long_text_is_cut_in_linear_time(spark):
    text = F.repeat(F.lit("word and \U0001f600 "), 400_000)  # 5 million code points
    count = spark.range(1).select(F.size(windows(text, 1200, 150))).first()[0]
    assert count == -(-(400_000 * 11 - 1) // 1050)


def test_markdown_sections(spark):
    cases = {
        "#\n## foo\nbar": [("## foo", "#\n## foo\nbar")],
        "#nope\n####### seven": [(None, "#nope\n####### seven")],
        "```\n# code\n```": [(None, "```\n"), ("code", "# code\n```")],
        "# A\nx\n## B\r\ny": [("A", "# A\nx\n"), ("B", "## B\r\ny")],
        "before\n# T": [(None, "before\n"), ("T", "# T")],
        "": [],
        "# one\n#  \n# two": [("one", "# one\n"), ("# two", "#  \n# two")],
    }
    got = by_row(texts(spark, list(cases)).select("i", ch.markdown_sections(F.col("text"))))
    assert [[(s["heading"], s["text"]) for s in row] for row in got] == list(cases.values())


def test_csv_row_groups(spark):
    many = "h\n" + "\n".join(str(i) for i in range(101)) + "\n"
    values = ["a,b\n", "", "a,b\n1,2\n\n3\n4,5,6\n", many, 'h\n"x, ""y""\nz"\n', None]
    got = by_row(texts(spark, values).select("i", ch.csv_pieces(F.col("text"), F.lit(None), JobConfig())))
    assert [(p["text"], p["rows"], p["columns"]) for p in got[0]] == [("a, b", "header", None)]
    assert got[1] == [] and got[5] is None
    assert [(p["text"], p["rows"], p["columns"]) for p in got[2]] == [
        ("a: 1; b: 2\n\na: 3\na: 4; b: 5; col2: 6", "1-4", ["a", "b"])
    ]
    assert [p["rows"] for p in got[3]] == ["1-50", "51-100", "101-101"]
    assert [p["text"] for p in got[4]] == ['h: x, "y"\nz']


def test_json_text(spark):
    cases = {
        '{"a":1.0,"b":[1e5,NaN],"a":2}': '{\n  "a": 2,\n  "b": [\n    100000.0,\n    NaN\n  ]\n}',
        "{bad": "{bad",
        " [1]": "[\n  1\n]",
        '{"é":"\\ud83d\\ude00"}': '{\n  "é": "\U0001f600"\n}',
        "plain": "plain",
    }
    df = texts(spark, list(cases)).select("i", ch.text_pieces(F.col("text"), F.lit(None), JobConfig())[0]["text"])
    assert by_row(df) == list(cases.values())


def test_routing(spark):
    cases = [
        ("README", "text/csv; x", "csv"), ("a.MD", "", "markdown"), ("a.b/c", "application/pdf", "pdf"), ("x", None, "text"),
        ("a.markdown", "application/pdf", "markdown"), ("a.mdx", "text/markdown", "markdown"), ("a", "TEXT/CSV", "text"),
    ]
    df = spark.createDataFrame([(i, k, c) for i, (k, c, _) in enumerate(cases)], "i INT, key STRING, type STRING")
    assert by_row(df.select("i", extractor_name(F.col("key"), F.col("type")))) == [e for _, _, e in cases]


def test_file_selection(spark):
    paths = ["a.md", "b/C.MDX", ".git/x.md", "b/.git/y.md", "c.txt", "b/.md", "b/a.md"]
    got = select_markdown_files(spark.createDataFrame([(p,) for p in paths], "path STRING"), "/docs/").collect()
    assert [(r["path"], r["key"]) for r in got] == [("a.md", "docs/a.md"), ("b/C.MDX", "docs/b/C.MDX"), ("b/a.md", "docs/b/a.md")]


def test_all_types_in_one_pass(spark):
    bodies = [
        ("a.md", b"# T\nbody"), ("b.csv", b"h\n1\n"), ("c.json", b'{"k":1}'), ("d.txt", b"\xff\xfe text"), ("e.txt", b" "),
        ("f.pdf", b""),
    ]
    docs = spark.createDataFrame(bodies, "key STRING, body BINARY").withColumns(
        {"bucket": F.lit("b"), "content_type": F.lit(""), "pages": F.when(F.col("key") == "f.pdf", F.array(F.lit("one"), F.lit(" "), F.lit("three")))}
    )
    chunkers = ch.Chunkers()
    rows = ch.chunk_documents(chunkers.route(identify(docs)), chunkers).orderBy("source_uri", "ordinal").collect()
    found = [(r["source_uri"][7:], r["ordinal"], r["text"], r["extractor"], r["n_chunks"]) for r in rows]
    assert found == [
        ("a.md", 0, "# T\nbody", "markdown", 1), ("b.csv", 0, "h: 1", "csv", 1), ("c.json", 0, '{\n  "k": 1\n}', "text", 1),
        ("d.txt", 0, "�� text", "text", 1), ("f.pdf", 0, "one", "pdf", 2), ("f.pdf", 1, "three", "pdf", 2),
    ]
    assert [r["metadata"]["page"] for r in rows if r["extractor"] == "pdf"] == [1, 3]
    assert rows[0]["metadata"]["heading"] == "T" and rows[1]["metadata"]["columns"] == ["h"]
    assert all(r["chunk_id"] == f"{r['doc_id']}:{r['ordinal']}" and len(r["doc_id"]) == 16 for r in rows)


def test_registered_chunker(spark):
    halves = ch.python_pieces(lambda t: [{"text": t[: len(t) // 2]}, {"text": t[len(t) // 2 :]}])
    chunkers = ch.Chunkers().register("half", lambda text, pages, config: halves(text), ["hlf"], ["text/half"])
    docs = spark.createDataFrame([("x.hlf", "", "abcd"), ("y", "text/half", "ef"), ("z.txt", "", "gh")], "key STRING, content_type STRING, body STRING")
    docs = chunkers.route(identify(docs.withColumn("bucket", F.lit("b"))))
    rows = ch.chunk_documents(docs, chunkers).orderBy("source_uri", "ordinal").collect()
    assert [r["text"] for r in rows] == ["ab", "cd", "e", "f", "gh"]


def test_json_members_and_html(spark):
    df = texts(spark, ['{"a":{"b":1,"c":{"d":[2]}},"e":null}', '[{"x":1},"y"]', "no json"])
    got = by_row(df.select("i", F.transform(json_object_pieces(2)(F.col("text"), F.lit(None), JobConfig()), lambda p: p["text"])))
    assert got == [["a.b: 1\na.c.d: [2]", "e: null"], ["0.x: 1", "1: y"], ["no json"]]
    page = "<!-- <p>no</p> --><p>one <b>two</b>\n three</p><script>var t='</p>'</script><div>a&amp;lt; <br>b</div>"
    assert by_row(texts(spark, [page]).select("i", html_blocks(F.col("text")))) == [["one two three", "a&lt;", "b"]]


def test_row_groups_of_a_hot_table(spark):
    """Positions with gaps, three slabs, one group holding most rows: the same as numbering each group by itself."""
    rows = spark.range(0, 2000).select(
        (F.col("id") * 97 + 5).alias("pos"), F.when(F.col("id") % 10 < 8, "hot").otherwise("cold").alias("t")
    )
    got = chunk_rows(rows, ["pos"], "pos", ["t"]).collect()
    for group in ("hot", "cold"):
        positions = sorted(r["pos"] for r in rows.where(F.col("t") == group).collect())
        mine = sorted((r for r in got if r["t"] == group), key=lambda r: r["ordinal"])
        assert [r["text"] for r in mine] == [
            "\n".join(f"pos: {p}" for p in positions[i : i + 50]) for i in range(0, len(positions), 50)
        ]
        assert mine[0]["rows"] == "1-50" and mine[-1]["rows"].endswith(f"-{len(positions)}")


def test_lines_as_one_text(spark):
    config = JobConfig(chunk_size=40, chunk_overlap=13)
    lines = [("a", i, f" turn {i} \U0001f600" + "x" * (i * 7 % 90) + "\n") for i in range(60)] + [("b", 3, "short"), ("b", 9, " ")]
    df = spark.createDataFrame(lines, "conv STRING, turn INT, line STRING")
    got = ch.chunk_lines(df, ["conv"], "turn", "line", config).collect()
    for conv in ("a", "b"):
        whole = "\n".join(t.strip() for c, _, t in lines if c == conv and t.strip())
        mine = [r["text"] for r in sorted((r for r in got if r["conv"] == conv), key=lambda r: r["window"])]
        (expected,) = by_row(texts(spark, [whole]).select("i", windows(F.col("text"), 40, 13)))
        assert mine == expected


def test_json_objects_lose_nothing(spark):
    cases = {
        '{"a":1}\n\n{"b":2}': ["1.a: 1", "2.b: 2"],
        '{"a":{}}': ['{"a":{}}'],
        "7": ["7"],
        '{"a":1} and more': ['{"a":1} and more'],
        "[]": ["[]"],
        " ": [],
    }
    df = texts(spark, list(cases))
    got = by_row(df.select("i", F.transform(json_object_pieces(2)(F.col("text"), F.lit(None), JobConfig()), lambda p: p["text"])))
    assert got == list(cases.values())
