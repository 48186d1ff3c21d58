"""The text operators on golden cases and by properties, and audits of trees on disk."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.operators import links, shell
from millrace.plans.markdown import RENAMES, hrefs_of
from millrace.sources import sinks
from millrace.sources import text as tree

PIECES = st.sampled_from(
    ["```bash\n", "```Shell \n", "  ```zsh\n", "```\n", "``` \n", "```python\n", "``` sh\n", "\n", " \n", "\t\n", "#!/bin/sh\n", "# note\n",
     "  # deep\n", "ls\n", "ls  # list\n", "ls   #\n", "ls #no\n", "'a  # b'  # c\n", "cd old/place\n", "new/place/sub", "x\x0b", "y\x85# z\n",
     " ", "  # nbsp\n", "```  # odd\n", "a\x00b\n", "z  # end", "  #", "## h\n", "  #!a  # b\n"]
)
TEXTS = st.lists(st.lists(PIECES, max_size=14).map("".join), min_size=150, max_size=150)


GOLDEN = [
    ("```bash\n# a\nls  # b\n```\n", "```bash\nls\n```\n", 2),
    ("```sh\n#!/bin/sh\nls\n```\n", None, 0),
    ("```zsh\n# never closed\nls\n", "```zsh\nls\n", 1),
    ("```python\n# kept\n```\n", None, 0),
    ("```python\n```bash\n# opens here\n```\n", "```python\n```bash\n```\n", 1),
    ("```sh\nls #no\nls  #no\n```\n", None, 0),
    ("```sh\nls  #\n```\n", "```sh\nls\n```\n", 1),
    ("```sh\nls\xa0\xa0# two wide blanks\n```\n", "```sh\nls\n```\n", 1),
    ("```Shell \n# x\n``` \n# y\n", "```Shell \n``` \n# y\n", 1),
    ("```sh\nls\n\n# c\n\npwd\n```\n", "```sh\nls\n\npwd\n```\n", 1),
    ("```console\n\n# first\n\n```\ntail", "```console\n```\ntail", 1),
    ("see cd old/place/sub", "see cd new/sub", 2),
    ("```sh\n'a  # b'  # c\n```\n", "```sh\n'a\n```\n", 1),
    ("", None, 0),
]


def test_golden_cases(spark):
    docs = spark.createDataFrame([(f"/{i}", text) for i, (text, _, _) in enumerate(GOLDEN)], "path string, value string")
    got = {r["path"]: (r["value"], r["n_changes"]) for r in shell.clean_shell_blocks(docs, RENAMES).collect()}
    for i, (text, cleaned, changes) in enumerate(GOLDEN):
        assert got[f"/{i}"] == (text if cleaned is None else cleaned, changes), repr(text)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(TEXTS)
def test_properties_of_generated_texts(spark, texts):
    docs = spark.createDataFrame([(f"/{i}", t) for i, t in enumerate(texts)], "path string, value string")
    lines = {}
    for r in shell.mark_fences(docs).orderBy("path", "pos").collect():
        lines.setdefault(r["path"], []).append((r["line"], r["role"]))
    for r in shell.clean_shell_blocks(docs).collect():
        text, own = texts[int(r["path"][1:])], lines.get(r["path"], [])
        assert "".join(line for line, _ in own) == text
        roles = "".join(role[0] for _, role in own)
        assert re.fullmatch("(t|ob*c)*(ob*)?", roles), roles
        if r["n_changes"] == 0:
            assert r["value"] == text
        # What lies outside of blocks comes through, in order.
        at = 0
        for line, role in own:
            if role != "body":
                at = r["value"].index(line, at) + len(line)
        if "b" not in roles:
            assert (r["value"], r["n_changes"]) == (text, 0)


def test_cleaning_twice_changes_nothing_more(spark):
    docs = spark.createDataFrame([("/a", "```sh\n# a\nls  # b\n\n\n#c\n\npwd\n```\n")], "path string, value string")
    once = shell.clean_shell_blocks(docs)
    assert once.first()["value"] == "```sh\nls\n\npwd\n```\n"
    again = shell.clean_shell_blocks(once.select("path", "value")).first()
    assert (again["value"], again["n_changes"]) == (once.first()["value"], 0)


def test_uncounted_blank_lines_leave_the_file_alone(spark):
    text = "```sh\n\n\nls\n\n```\n"
    row = shell.clean_shell_blocks(spark.createDataFrame([("/a", text)], "path string, value string")).first()
    assert (row["value"], row["n_changes"]) == (text, 0)


def test_a_long_block_does_not_deepen_the_stack(spark):
    text = "```bash\n" + "echo x  # y\n" * 200_000
    row = shell.clean_shell_blocks(spark.createDataFrame([("/a", text)], "path string, value string")).first()
    assert row["n_changes"] == 200_000 and row["value"].count("#") == 0


def test_links(spark):
    text = "[![b](i.png)](page.md) [a](x.md#part) [up](../../../..) [abs](/r/y.md) [mail](mailto:x) [t](z.md \"t\") [m\nn]( q.md ) []() [#](#a)"
    docs = spark.createDataFrame([("/r/s/d.md", text)], "path string, value string")
    found = links.extract_links(docs).orderBy("pos").collect()
    assert [(r["link_text"], r["link_url"]) for r in found] == re.findall(r"\[([^\]]+)\]\(([^)]+)\)", text)
    targets = [r["target"] for r in links.link_targets(links.extract_links(docs)).orderBy("pos").collect()]
    assert targets == ["/r/s/i.png", "/r/s/x.md", "/", "/r/y.md", '/r/s/z.md "t"', "/r/s/q.md"]


def test_unicode_space_is_stripped(spark):
    row = spark.createDataFrame([(" a b \x1c",)], "v string").select(T.strip(F.col("v")).alias("v")).first()
    assert row["v"] == "a b"


def test_audit_of_a_tree(spark, tmp_path):
    root = tmp_path / "t r+ee%20"
    (root / "docs").mkdir(parents=True)
    (root / "empty").mkdir()
    (root / ".venv").mkdir()
    (root / "index.md").write_text("[d](docs) [g](docs/good%20one.md) [ok](docs/good one.md#x) [no](docs/none.md) [e](https://x)\r\n")
    (root / "docs" / "good one.md").write_text("[up](../index.md) [self](./../docs/good one.md) [pic](p+1.png)")
    (root / "docs" / "p+1.png").write_bytes(b"\x00")
    (root / "docs" / "plain.md").write_text("nothing")
    (root / ".venv" / "x.md").write_text("[gone](gone.md)")
    docs = tree.scan_text_tree(spark, str(root), "*.md", (".venv", "__pycache__"))
    inventory = links.with_folders(tree.file_inventory(spark, str(root)).select("path"))
    broken = links.broken_links(links.extract_links(docs), inventory)
    assert {(r["path"].split("/")[-1], r["link_url"]) for r in broken.collect()} == {("index.md", "docs/good%20one.md"), ("index.md", "docs/none.md")}
    total = links.link_audit_summary(docs, inventory).first()
    assert tuple(total) == (3, 8, 2, 1, 1)
    assert [(r["n_broken"], r["broken"]) for r in links.broken_by_file(broken).collect()] == [(2, "[g](docs/good%20one.md)\n[no](docs/none.md)")]
    assert "\r" not in "".join(r["value"] for r in docs.collect())


def test_audit_without_broken_links_passes(spark):
    docs = spark.createDataFrame([("/a/b.md", "[x](b.md)")], "path string, value string")
    assert tuple(links.link_audit_summary(docs, links.with_folders(docs.select("path"))).first()) == (1, 1, 0, 0, 0)


def test_only_changed_files_are_written(spark, tmp_path):
    docs = spark.createDataFrame([("/a", "```sh\n# x\n```\n"), ("/b", "plain")], "path string, value string")
    sinks.write_changed(shell.clean_shell_blocks(docs), str(tmp_path / "out"))
    assert [r["path"] for r in spark.read.parquet(str(tmp_path / "out")).collect()] == ["/a"]


def test_report_order(spark):
    rows = spark.createDataFrame([("/b", 2), ("/a", 2), ("/c", 5), ("/d", 0)], "path string, n_changes long")
    assert [r["path"] for r in shell.changes_report(rows).collect()] == ["/c", "/a", "/b"]


def test_very_many_blocks_in_one_text(spark):
    block = "```bash\nls  # x\n```\n```\n"
    df = spark.range(1).select(T.split_lines(F.repeat(F.lit(block), 64_000)).alias("lines"))
    located = df.select(F.inline(F.array(F.struct("lines")))).select(T.shell_blocks(F.col("lines")).alias("b"))
    assert tuple(located.select(F.size("b"), F.get("b", 1)["opening"], F.element_at("b", -1)["closing"]).first()) == (64_000, 4, 4 * 64_000 - 2)


def test_hrefs_in_any_spelling(spark):
    html = """<a href="/a b">x</a> <A HREF='/b"c'>x</A> <a class=k href = /c>x</a> <a Href= "/d" id=1> <a href=""> <script>a.href = b;</script>"""
    assert spark.createDataFrame([(html,)], "html string").select(hrefs_of("html")).first()[0] == ["/a b", '/b"c', "/c", "/d", ""]
