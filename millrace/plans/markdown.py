"""Queries over a Markdown corpus that is derived from the whole documents table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.operators import links, shell
from millrace.session import scratch_dir, settle, spread, table
from millrace.sources import sinks
from millrace.sources import text as tree

# The folders that each job leaves out.
AUDIT_EXCLUDE = (".venv", "__pycache__")
CLEAN_EXCLUDE = (".git", ".venv", "__pycache__", "datasets", "node_modules")
RENAMES = (("cd old/place", "cd new/place"), ("new/place/sub", "new/sub"))

# The corpus in SQL that Spark and DuckDB read alike: each document becomes a
# Markdown file with links of every kind and its text inside and outside fences.
PATH_SQL = """concat('/site/', CASE source WHEN 'src3' THEN '.venv/' WHEN 'src7' THEN 'node_modules/' ELSE '' END,
  source, '/doc_', CAST(doc_id AS STRING), '.md')"""
VALUE_SQL = """concat('# Document ', CAST(doc_id AS STRING), chr(10),
  '[![badge](img/', CAST(doc_id AS STRING), '.png)](../index.md) ',
  '[next](../src', CAST((doc_id + 1) % 20 AS STRING), '/doc_', CAST(doc_id + 1 AS STRING), '.md#top) ',
  '[folder](../', source, ') [dot](./../', source, '/./doc_', CAST(doc_id AS STRING), '.md) ',
  '[up](../../../../site) [abs](/site/', source, ') [web](https://example.com/', CAST(doc_id AS STRING), ') ',
  '[mail](mailto:a@example.com) [anchor](#part) [titled](doc_', CAST(doc_id AS STRING), '.md "title") ',
  '[gone]( missing_', CAST(doc_id AS STRING), '.md )', chr(10),
  CASE WHEN lang = 'de' THEN '' ELSE concat('```bash', chr(10), '#!/bin/sh', chr(10), '# set up', chr(10), chr(10),
    chr(10), 'echo ', lang, '  # say ', CAST(doc_id AS STRING), chr(10), chr(10), '# again', chr(10), chr(10),
    'cd old/place/sub  #', chr(10), chr(10), '```', chr(10)) END,
  '```python', chr(10), '# kept', chr(10), '```', chr(10), text, chr(10),
  CASE lang WHEN 'en' THEN '   ```Shell ' WHEN 'de' THEN '```sql' ELSE '``` console' END, chr(10),
  replace(replace(text, ', ', '  # '), '. ', concat('.', chr(10), '# ')))"""


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents"), "doc_id").select(F.expr(PATH_SQL).alias("path"), F.expr(VALUE_SQL).alias("value"))


def p1_extract_links(spark, sf_dir):
    return links.extract_links(corpus(spark, sf_dir))


def p2_strip_anchor(spark, sf_dir):
    found = links.extract_links(corpus(spark, sf_dir))
    return found.select("path", "pos", T.strip_anchor(F.col("link_url")).alias("url"))


def p3_is_checkable(spark, sf_dir):
    cut = p2_strip_anchor(spark, sf_dir)
    return cut.where(T.is_checkable(F.col("url"))).groupBy("path").agg(F.count("*").alias("n_checkable"))


def p4_resolve_path(spark, sf_dir):
    return links.link_targets(links.extract_links(corpus(spark, sf_dir))).select("path", "pos", "target")


def p5_exclude_parts(spark, sf_dir):
    return links.exclude_parts(corpus(spark, sf_dir), CLEAN_EXCLUDE).select("path", F.length("value").alias("n_chars"))


def p6_mark_fences(spark, sf_dir):
    return shell.mark_fences(corpus(spark, sf_dir)).select(
        "path", "pos", "role", "block_id", F.rtrim("line", F.lit("\n")).alias("line")
    )


def _bodies(spark, sf_dir):
    return shell.block_bodies(corpus(spark, sf_dir))


def p7_drop_comment_lines(spark, sf_dir):
    kept = _bodies(spark, sf_dir).withColumn("kept", T.drop_comment_lines(F.col("body")))
    return kept.select(
        "path",
        "block_id",
        (F.size("body") - F.size("kept")).alias("n_dropped"),
        F.array_join("kept", "").alias("kept"),
    )


def p8_collapse_blank_lines(spark, sf_dir):
    kept = T.collapse_blank_lines(T.drop_comment_lines(F.col("body")))
    return _bodies(spark, sf_dir).select("path", "block_id", F.array_join(kept, "").alias("kept"))


def p9_strip_inline_comment(spark, sf_dir):
    lines = shell.mark_fences(corpus(spark, sf_dir)).where("role = 'body'")
    return lines.select("path", "pos", T.strip_inline_comment(F.col("line")).alias("cleaned"), "line").select(
        "path", "pos", "cleaned", (F.col("cleaned") != F.col("line")).cast("int").alias("changed")
    )


def p10_trim_block(spark, sf_dir):
    return _bodies(spark, sf_dir).select("path", "block_id", F.array_join(T.trim_block(F.col("body")), "").alias("kept"))


def p11_replace_literals(spark, sf_dir):
    text, hits = shell.replace_literals(F.col("value"), RENAMES)
    return corpus(spark, sf_dir).select("path", text.alias("value"), hits.alias("n_changes"))


def p12_clean_shell_blocks(spark, sf_dir):
    return shell.clean_shell_blocks(links.exclude_parts(corpus(spark, sf_dir), CLEAN_EXCLUDE), RENAMES)


def s10_write_changed(spark, sf_dir):
    path = scratch_dir(spark, "cleaned")
    sinks.write_changed(p12_clean_shell_blocks(spark, sf_dir), path)
    return spark.read.schema("path string, value string, n_changes long").parquet(path)


def o1_changes_report(spark, sf_dir):
    return shell.changes_report(p12_clean_shell_blocks(spark, sf_dir))


def _audited(spark, sf_dir):
    """The files to audit, and every path of the corpus."""
    docs = corpus(spark, sf_dir)
    return links.exclude_parts(docs, AUDIT_EXCLUDE), links.with_folders(docs.select("path"))


def _broken(spark, sf_dir):
    audited, inventory = _audited(spark, sf_dir)
    return links.broken_links(links.extract_links(audited), inventory)


def j1_broken_links(spark, sf_dir):
    return _broken(spark, sf_dir).select("path", "pos", "link_text", "link_url", "target")


def a1_link_audit_summary(spark, sf_dir):
    return links.link_audit_summary(*_audited(spark, sf_dir))


def a2_broken_by_file(spark, sf_dir):
    return links.broken_by_file(_broken(spark, sf_dir))


#: An attribute in either case, its value in double, single or no quotes; the property of a script is none.
HREF = r"""(?i)(?<![.\w])href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>][^\s>]*)"""


def hrefs_of(html):
    """The values of the href attributes of a page, without their quotes."""
    return F.transform(F.regexp_extract_all(html, F.lit(HREF), F.lit(1)), lambda v: F.regexp_replace(v, r"""^["']|["']$""", ""))


def j1_page_links(spark, sf_dir):
    """Links of the web pages against the paths that the pages themselves have."""
    pages = table(spark, sf_dir, "pages").select(
        F.regexp_extract("url", r"^[a-z]+://[^/]+(/[^?#]*)", 1).alias("path"), "page_id", "html"
    )
    hrefs = pages.select("page_id", "path", F.explode(hrefs_of(F.col("html"))).alias("href"))
    targets = hrefs.select("page_id", T.strip_anchor(F.col("href")).alias("url"), "path")
    targets = targets.where(T.is_checkable(F.col("url"))).withColumn("target", T.resolve_path(F.col("path"), F.col("url")))
    missing = targets.join(links.with_folders(pages.select("path")), "target", "left_anti")
    return missing.groupBy("page_id").agg(F.count("*").alias("n_missing"))


def _written_tree(spark, sf_dir):
    """Document texts as files below one folder per source, at most 200 texts to a file."""
    path = scratch_dir(spark, "tree")
    docs = table(spark, sf_dir, "documents").select("text", "source")
    docs.write.partitionBy("source").option("maxRecordsPerFile", 200).text(path)
    return path


# A tree with one folder and one file for each document, as written files are named by Spark.
PAGE_SQL = "concat('/source=', source, '/doc_id=', CAST(doc_id AS STRING), '/page')"
LINKED_SQL = f"""concat('[next](../doc_id=', CAST(doc_id + 1 AS STRING), ') [all](../../source=', source, '/) ',
  '[top](../..#start) [gone](missing.md) [web](https://example.com/x)', chr(10), {VALUE_SQL})"""


def _file_tree(spark, sf_dir):
    """The corpus as files; every file holds one document."""
    path = scratch_dir(spark, "files")
    # A file costs the same however short it is, so rows are dealt over tasks whatever their size, those of a folder to one.
    docs = table(spark, sf_dir, "documents").select("source", "doc_id", F.expr(LINKED_SQL).alias("value")).repartition("source", "doc_id")
    # Rows of a folder lie together and its file ends where its document does; no line end is added.
    sinks.write_text_folders(docs, path, ["source", "doc_id"], "\0")
    return path


def _page(path):
    """The folder of a written file as the path of its page."""
    return F.concat(F.regexp_extract(path, r"(/source=[^/]*/doc_id=[^/]*)/[^/]*\z", 1), F.lit("/page"))


def _scanned_pages(spark, root):
    files = tree.scan_text_tree(spark, root, "*.txt", AUDIT_EXCLUDE)
    return files.select(_page(F.col("path")).alias("path"), F.rtrim("value", F.lit("\0")).alias("value"))


def a1_audit_of_files(spark, sf_dir):
    """Files written, scanned and listed, then audited: S1, S2, J1 and A1 in a row."""
    root = _file_tree(spark, sf_dir)
    listed = tree.file_inventory(spark, root).where(F.endswith("path", F.lit(".txt")))
    inventory = links.with_folders(listed.select(_page(F.col("path")).alias("path")))
    with tree.small_files(spark):
        return settle(links.link_audit_summary(_scanned_pages(spark, root), inventory), "audit")


def p12_clean_files(spark, sf_dir):
    """Files written and scanned, cleaned, and the changed ones written: S1, P12 and S10 in a row."""
    path = scratch_dir(spark, "cleaned-files")
    root = _file_tree(spark, sf_dir)
    with tree.small_files(spark):
        sinks.write_changed(shell.clean_shell_blocks(_scanned_pages(spark, root), RENAMES), path)
    return spark.read.schema("path string, value string, n_changes long").parquet(path)


def s1_scan_text_tree(spark, sf_dir):
    files = tree.scan_text_tree(spark, _written_tree(spark, sf_dir), "*.txt", ("source=src3",))
    source = F.regexp_extract("path", r"/source=([^/]*)/", 1).alias("source")
    n_lines = F.size(T.split_lines(F.col("value")))
    return files.select(source, n_lines.alias("n")).groupBy("source").agg(F.sum("n").alias("n_lines"))


def s2_file_inventory(spark, sf_dir):
    files = tree.file_inventory(spark, _written_tree(spark, sf_dir))
    named = files.where(F.endswith("path", F.lit(".txt")))
    source = F.regexp_extract("path", r"/source=([^/]*)/", 1).alias("source")
    return named.groupBy(source).agg(F.sum("length").alias("n_bytes"))


QUERIES = {
    f.__name__: f
    for f in (
        s1_scan_text_tree, s2_file_inventory, s10_write_changed, p1_extract_links, p2_strip_anchor, p3_is_checkable,
        p4_resolve_path, p5_exclude_parts, p6_mark_fences, p7_drop_comment_lines, p8_collapse_blank_lines,
        p9_strip_inline_comment, p10_trim_block, p11_replace_literals, p12_clean_shell_blocks, o1_changes_report,
        j1_broken_links, j1_page_links, a1_link_audit_summary, a2_broken_by_file, a1_audit_of_files, p12_clean_files,
    )
}

# --- the same results in SQL, built on line relations and window functions ---

_MD = f"md AS (SELECT {PATH_SQL} AS path, {VALUE_SQL} AS value FROM documents)"
_LINKS = _MD + r""",
found AS (SELECT path, unnest(regexp_extract_all(value, '\[([^\]]+)\]\(([^)]+)\)')) AS m,
  generate_subscripts(regexp_extract_all(value, '\[([^\]]+)\]\(([^)]+)\)'), 1) - 1 AS pos FROM md),
links AS (SELECT path, pos, regexp_extract(m, '\[([^\]]+)\]\(([^)]+)\)', 1) AS link_text,
  regexp_extract(m, '\[([^\]]+)\]\(([^)]+)\)', 2) AS link_url FROM found),
cut AS (SELECT path, pos, link_text, trim(split_part(link_url, '#', 1), chr(32) || chr(10) || chr(9)) AS url FROM links),
checkable AS (SELECT * FROM cut WHERE url <> '' AND NOT (starts_with(url, 'http://') OR starts_with(url, 'https://')
  OR starts_with(url, 'mailto:') OR starts_with(url, 'computer://') OR starts_with(url, '#')))"""


def _resolved(base: str, url: str) -> str:
    return f"""'/' || ltrim(list_reduce(list_filter(string_split(CASE WHEN starts_with({url}, '/') THEN {url}
  ELSE regexp_replace({base}, '[^/]*$', '') || {url} END, '/'), lambda s: s <> '' AND s <> '.'),
  lambda acc, s: CASE WHEN s = '..' THEN regexp_replace(acc, '/?[^/]*$', '') ELSE acc || '/' || s END, ''), '/')"""


_TARGETS = _LINKS + f", targets AS (SELECT *, {_resolved('path', 'url')} AS target FROM checkable)"


def _folders(source: str) -> str:
    return f"""inventory AS (SELECT DISTINCT '/' || array_to_string(list_slice(parts, 1, n), '/') AS target
  FROM (SELECT parts, unnest(range(0, len(parts) + 1)) AS n
    FROM (SELECT list_filter(string_split(path, '/'), lambda s: s <> '') AS parts FROM {source})))"""


_NOT_AUDITED = "NOT list_has_any(string_split(path, '/'), ['.venv', '__pycache__'])"
_NOT_CLEANED = "NOT list_has_any(string_split(path, '/'), ['.git', '.venv', '__pycache__', 'datasets', 'node_modules'])"
_BROKEN = (
    _TARGETS
    + ", "
    + _folders("md")
    + f", broken AS (SELECT * FROM targets t WHERE {_NOT_AUDITED} AND NOT EXISTS (SELECT 1 FROM inventory i WHERE i.target = t.target))"
)

# Lines with their newline; the last one has none and vanishes when empty.
_LINES = _MD + r""",
split AS (SELECT path, string_split(value, chr(10)) AS parts FROM md),
cells AS (SELECT path, len(parts) AS n, unnest(parts) AS line, generate_subscripts(parts, 1) - 1 AS pos FROM split),
lines AS (SELECT path, pos, CASE WHEN pos = n - 1 THEN line ELSE line || chr(10) END AS line FROM cells
  WHERE NOT (pos = n - 1 AND line = '')),
marked AS (SELECT *, CASE WHEN regexp_matches(line, '(?i)^\s*```(bash|sh|shell|zsh|console)\s*$') THEN 'O'
  WHEN trim(line, chr(32) || chr(10)) = '```' THEN 'C' END AS marker FROM lines),
state AS (SELECT *, last_value(marker IGNORE NULLS) OVER (PARTITION BY path ORDER BY pos
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior FROM marked),
roles AS (SELECT *, CASE WHEN prior = 'O' AND marker = 'C' THEN 'close' WHEN prior = 'O' THEN 'body'
  WHEN marker = 'O' THEN 'open' ELSE 'text' END AS role FROM state),
fences AS (SELECT path, pos, line, role, CASE WHEN role <> 'text' THEN
  sum(CASE WHEN role = 'open' THEN 1 ELSE 0 END) OVER (PARTITION BY path ORDER BY pos) END AS block_id FROM roles),
blocks AS (SELECT path, block_id FROM fences WHERE role = 'open'),
body AS (SELECT *, trim(line, chr(32) || chr(10)) AS bare FROM fences WHERE role = 'body'),
cleaned AS (SELECT *, starts_with(bare, '#') AND NOT starts_with(bare, '#!') AS is_comment,
  CASE WHEN regexp_matches(line, '\s{2,}#\s') THEN
    rtrim(regexp_replace(rtrim(line, chr(10)), '\s{2,}#.*$', ''), chr(32) || chr(10)) || chr(10) ELSE line END AS clean FROM body),
lagged AS (SELECT *, lag(trim(clean, chr(32) || chr(10))) OVER (PARTITION BY path, block_id ORDER BY pos) AS before
  FROM cleaned WHERE NOT is_comment),
collapsed AS (SELECT * FROM lagged WHERE NOT (bare = '' AND before IS NOT NULL AND before = '')),
edges AS (SELECT *, min(CASE WHEN trim(clean, chr(32) || chr(10)) <> '' THEN pos END) OVER (PARTITION BY path, block_id) AS lo,
  max(CASE WHEN trim(clean, chr(32) || chr(10)) <> '' THEN pos END) OVER (PARTITION BY path, block_id) AS hi FROM collapsed),
trimmed AS (SELECT path, pos, clean FROM edges WHERE pos BETWEEN lo AND hi),
rebuilt AS (SELECT path, string_agg(line, '' ORDER BY pos) AS value FROM (
  SELECT path, pos, line FROM fences WHERE role <> 'body' UNION ALL SELECT path, pos, clean FROM trimmed) GROUP BY path),
counted AS (SELECT path, sum(CASE WHEN is_comment THEN 1 WHEN clean <> line THEN 1 ELSE 0 END) AS n FROM cleaned GROUP BY path),
renamed AS (SELECT r.path, replace(replace(r.value, 'cd old/place', 'cd new/place'), 'new/place/sub', 'new/sub') AS value,
  coalesce(c.n, 0) + (length(r.value) - length(replace(r.value, 'cd old/place', ''))) // 12
    + (length(replace(r.value, 'cd old/place', 'cd new/place'))
       - length(replace(replace(r.value, 'cd old/place', 'cd new/place'), 'new/place/sub', ''))) // 13 AS n_changes
  FROM rebuilt r LEFT JOIN counted c ON r.path = c.path)"""
_CLEANED = (
    _LINES
    + f""", final AS (SELECT m.path, CASE WHEN r.n_changes > 0 THEN r.value ELSE m.value END AS value,
  CAST(r.n_changes AS BIGINT) AS n_changes FROM md m JOIN renamed r ON m.path = r.path WHERE {_NOT_CLEANED.replace('path', 'm.path')})"""
)


def _of_files(sql: str) -> str:
    """A twin over the tree of files in place of the corpus."""
    return sql.replace(_MD, f"md AS (SELECT {PAGE_SQL} AS path, {LINKED_SQL} AS value FROM documents)")


def _audit_sql(where: str) -> str:
    return f"""SELECT (SELECT count(*) FROM md WHERE {where}) AS files_scanned,
        (SELECT count(*) FROM links WHERE {where}) AS links_total, (SELECT count(*) FROM broken) AS links_broken,
        (SELECT count(DISTINCT path) FROM broken) AS files_with_broken,
        (SELECT CASE WHEN count(*) = 0 THEN 0 ELSE 1 END FROM broken) AS exit_code"""


def _block_text(relation: str, column: str, where: str = "true") -> str:
    return f"""SELECT b.path, CAST(b.block_id AS INTEGER) AS block_id,
  coalesce(string_agg({column}, '' ORDER BY pos), '') AS kept
  FROM blocks b LEFT JOIN (SELECT * FROM {relation} WHERE {where}) x ON b.path = x.path AND b.block_id = x.block_id
  GROUP BY b.path, b.block_id"""


ORACLES = {
    "s1_scan_text_tree": """SELECT source, CAST(sum(len(string_split(text, chr(10)))) AS BIGINT) AS n_lines
        FROM documents WHERE source <> 'src3' GROUP BY source""",
    "s2_file_inventory": "SELECT source, CAST(sum(strlen(text) + 1) AS BIGINT) AS n_bytes FROM documents GROUP BY source",
    "s10_write_changed": f"WITH {_CLEANED} SELECT * FROM final WHERE n_changes > 0",
    "p1_extract_links": f"WITH {_LINKS} SELECT path, CAST(pos AS INTEGER) AS pos, link_text, link_url FROM links",
    "p2_strip_anchor": f"WITH {_LINKS} SELECT path, CAST(pos AS INTEGER) AS pos, url FROM cut",
    "p3_is_checkable": f"WITH {_LINKS} SELECT path, count(*) AS n_checkable FROM checkable GROUP BY path",
    "p4_resolve_path": f"WITH {_TARGETS} SELECT path, CAST(pos AS INTEGER) AS pos, target FROM targets",
    "p5_exclude_parts": f"WITH {_MD} SELECT path, CAST(length(value) AS INTEGER) AS n_chars FROM md WHERE {_NOT_CLEANED}",
    "p6_mark_fences": f"""WITH {_LINES} SELECT path, CAST(pos AS INTEGER) AS pos, role, CAST(block_id AS INTEGER) AS block_id,
        rtrim(line, chr(10)) AS line FROM fences""",
    "p7_drop_comment_lines": f"""WITH {_LINES} SELECT b.path, CAST(b.block_id AS INTEGER) AS block_id,
        CAST(count(*) FILTER (is_comment) AS INTEGER) AS n_dropped,
        coalesce(string_agg(line, '' ORDER BY pos) FILTER (NOT is_comment), '') AS kept
        FROM blocks b LEFT JOIN cleaned c ON b.path = c.path AND b.block_id = c.block_id GROUP BY b.path, b.block_id""",
    "p8_collapse_blank_lines": f"WITH {_LINES} {_block_text('collapsed', 'clean')}",
    "p9_strip_inline_comment": f"""WITH {_LINES} SELECT path, CAST(pos AS INTEGER) AS pos, clean AS cleaned,
        CASE WHEN clean <> line THEN 1 ELSE 0 END AS changed FROM cleaned""",
    "p10_trim_block": f"""WITH {_LINES}, bounds AS (SELECT *,
        min(CASE WHEN bare <> '' THEN pos END) OVER (PARTITION BY path, block_id) AS lo,
        max(CASE WHEN bare <> '' THEN pos END) OVER (PARTITION BY path, block_id) AS hi FROM body)
        {_block_text('bounds', 'line', 'pos BETWEEN lo AND hi')}""",
    "p11_replace_literals": f"""WITH {_MD} SELECT path,
        replace(replace(value, 'cd old/place', 'cd new/place'), 'new/place/sub', 'new/sub') AS value,
        CAST(len(string_split(value, 'cd old/place')) - 1
          + len(string_split(replace(value, 'cd old/place', 'cd new/place'), 'new/place/sub')) - 1 AS BIGINT) AS n_changes FROM md""",
    "p12_clean_shell_blocks": f"WITH {_CLEANED} SELECT * FROM final",
    "o1_changes_report": f"WITH {_CLEANED} SELECT path, n_changes FROM final WHERE n_changes > 0 ORDER BY n_changes DESC, path",
    "j1_broken_links": f"WITH {_BROKEN} SELECT path, CAST(pos AS INTEGER) AS pos, link_text, url AS link_url, target FROM broken",
    "j1_page_links": r"""WITH pg AS (SELECT page_id, regexp_extract(url, '^[a-z]+://[^/]+(/[^?#]*)', 1) AS path, html FROM pages),
        hrefs AS (SELECT page_id, path, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS href FROM pg),
        cut AS (SELECT page_id, path, trim(split_part(href, '#', 1)) AS url FROM hrefs),
        targets AS (SELECT page_id, """
    + _resolved("path", "url")
    + """ AS target FROM cut WHERE url <> '' AND NOT regexp_matches(url, '^(https?://|mailto:|computer://|#)')), """
    + _folders("pg")
    + """ SELECT page_id, count(*) AS n_missing FROM targets WHERE target NOT IN (SELECT target FROM inventory) GROUP BY page_id""",
    "a1_link_audit_summary": f"WITH {_BROKEN} {_audit_sql(_NOT_AUDITED)}",
    "a1_audit_of_files": _of_files(f"WITH {_BROKEN} {_audit_sql(_NOT_AUDITED)}"),
    "p12_clean_files": _of_files(f"WITH {_CLEANED} SELECT * FROM final WHERE n_changes > 0"),
    "a2_broken_by_file": f"""WITH {_BROKEN} SELECT path, count(*) AS n_broken,
        string_agg('[' || link_text || '](' || url || ')', chr(10) ORDER BY pos) AS broken FROM broken GROUP BY path""",
}
