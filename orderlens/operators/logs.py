"""Semi-structured text: conversation logs written as text and read back, report tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens import constants as C
from orderlens.schemas import ANSWER

RULE = "-" * 30


def render_turn(turn: Column, user: Column, path: Column, blocked: Column, answer_json: Column,
                state: Column) -> Column:
    """One turn as a log block."""
    return F.concat(
        F.lit(f"{RULE}\nTURN "), turn.cast("string"), F.lit(f"\n{RULE}\nUSER: "),
        F.regexp_replace(user, r"[\r\n]+", " "), F.lit("\n\n-- GRAPH PATH --\n   "), path,
        F.lit("\n\nBLOCKED          : "), F.when(blocked == 1, "True").otherwise("False"),
        F.lit("\n\n-- FINAL STRUCTURED RESPONSE --\n   "), answer_json,
        F.lit("\n\n-- CONVERSATION STATE AFTER THIS TURN --\n"), state, F.lit("\n\n"))


def render_log(blocks: DataFrame, key: list[str], order: str, block: str,
               header: Column) -> DataFrame:
    """Log files of a bounded number of turns; ``key`` must include the file segment."""
    return blocks.groupBy(*key).agg(
        F.array_sort(F.collect_list(F.struct(order, block))).alias("_b")).select(
        *key, F.concat(header, F.lit("\n\n"), F.array_join(F.col(f"_b.{block}"), ""))
        .alias("content"))


def sections(block: Column) -> Column:
    """Named parts of a text as an array of (name, body); what comes first has no name."""
    names = F.concat(F.array(F.lit("")), F.regexp_extract_all(
        block, F.lit(C.LOG_SECTION), F.lit(1)))
    return F.arrays_zip(names.alias("name"), F.split(block, C.LOG_SECTION).alias("body"))


def section(parts: Column, name: str) -> Column:
    """Body of the first section with a name; NULL without one."""
    return F.get(F.filter(parts, lambda p: p["name"] == name), F.lit(0))["body"]


def labelled(text: Column) -> Column:
    """``key : value`` lines as an array of (key, value), both trimmed; the key ends at the
    first colon."""
    entries = F.transform(F.split(text, r"\r?\n"), lambda line: F.struct(
        F.trim(F.element_at(F.split(line, ":", 2), 1)).alias("key"),
        F.trim(F.get(F.split(line, ":", 2), F.lit(1))).alias("value")))
    return F.filter(entries, lambda e: (e["key"] != "") & (e["value"] != ""))


def _first(entries: Column, key: Column | str) -> Column:
    return F.get(F.filter(entries, lambda e: e["key"] == key), F.lit(0))["value"]


def _as_map(entries: Column) -> Column:
    """Later lines with a key seen before are left out."""
    keys = F.array_distinct(F.transform(entries, lambda e: e["key"]))
    values = F.transform(keys, lambda k: _first(entries, k))
    return F.map_from_arrays(keys, values)


def log_header(content: Column) -> Column:
    """Known lines before the first rule, as a map."""
    head = F.element_at(F.split(content, r"(?m)^---", 2), 1)
    return _as_map(F.filter(labelled(head), lambda e: e["key"].isin(C.LOG_HEADER_KEYS)))


def parse_logs(files: DataFrame, content: str = "content") -> DataFrame:
    """One row per turn: label, user text, path, blocked flag, answer struct, state map.

    Every turn is cut into its sections once; each column is a typed reader of one section.
    A section that is not there gives NULL, and so does a broken answer.
    """
    kept = [c for c in files.columns if c != content]
    labels = F.regexp_extract_all(content, F.lit(C.LOG_TURN), F.lit(1))
    blocks = F.slice(F.split(content, C.LOG_TURN), F.lit(2), F.greatest(F.size(labels), F.lit(1)))
    cut_up = files.select(
        *kept, log_header(F.col(content)).alias("header"),
        F.arrays_zip(F.transform(labels, lambda x: F.trim(x)).alias("turn_label"),
                     blocks.alias("_block")).alias("_turns"))
    turns = cut_up.select(*kept, "header", F.inline("_turns"))
    cut = turns.withColumn("_parts", sections(F.col("_block")))
    parts = F.col("_parts")
    route = section(parts, C.LOG_PATH)
    steps = F.split(F.element_at(F.split(F.trim(F.regexp_replace(route, r"^\s+", "")), r"\n"), 1),
                    "->")
    flag = _first(labelled(F.array_join(F.transform(parts, lambda p: p["body"]), "\n")), "BLOCKED")
    # The state ends at the first empty line.
    state = F.element_at(F.split(F.regexp_replace(
        section(parts, C.LOG_STATE), r"^[ \t]*\n", ""), r"\n[ \t]*\n", 2), 1)
    answer = F.regexp_extract(section(parts, C.LOG_RESPONSE), r"(?s)\{.*\}", 0)
    return cut.select(
        *kept, "header", "turn_label", _first(labelled(section(parts, "")), "USER").alias("user"),
        F.transform(steps, lambda x: F.trim(x)).alias("graph_path"),
        F.when(flag.isin("True", "False"), (flag == "True").cast("int")).alias("blocked"),
        F.from_json(F.nullif(answer, F.lit("")), ANSWER).alias("response"),
        _as_map(labelled(state)).alias("state_after"))


def table_section(markdown: Column, header: str) -> Column:
    """Text between a header line and the next ``## `` line."""
    after = F.element_at(F.split(markdown, r"\Q" + header + r"\E", 2), 2)
    return F.element_at(F.split(after, r"## ", 2), 1)


def section_rows(df: DataFrame, section: Column, pattern: str, fields: list[tuple[str, str]]
                 ) -> DataFrame:
    """Every match of ``pattern`` in a section as a row with typed capture groups."""
    whole = F.regexp_extract_all(section, F.lit(pattern), F.lit(0))
    rows = df.select(*df.columns, F.posexplode(whole).alias("row", "_m"))
    return rows.select(*df.columns, "row", *[
        F.regexp_extract("_m", pattern, i + 1).try_cast(kind).alias(name)
        for i, (name, kind) in enumerate(fields)])
