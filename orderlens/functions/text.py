"""Text expressions: sentence split, tokens, slot extraction, guard patterns, formatting.

Regular expressions run as Java patterns inside the JVM; no Python is involved.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderlens import constants as C

EDGE_SPACE = r"^\s+|\s+$"


def strip(text: Column) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.regexp_replace(text, EDGE_SPACE, "")


def sentences(text: Column) -> Column:
    """Split after . ! or ? followed by white space; trimmed, no empty entries."""
    parts = F.split(strip(text), r"(?<=[.!?])\s+")
    return F.filter(F.transform(parts, strip), lambda s: s != "")


def tokens(text: Column) -> Column:
    """Lower-case letter and digit runs."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def words(text: Column) -> Column:
    """White-space separated words."""
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")


def has_word(text: Column, words: list[str]) -> Column:
    """Does a text contain one of some lower-case pieces; far cheaper than a pattern."""
    lowered = F.lower(text)
    return reduce(lambda a, b: a | b, [lowered.contains(w) for w in words])


def first_group(text: Column, pattern: str, groups: int = 1,
                words: list[str] | None = None) -> Column:
    """First non-empty capture group of the first match, NULL without a match. Texts without
    any of ``words``, where given, are not tried."""
    insensitive = "(?i)" + pattern
    found = F.coalesce(
        *[F.nullif(F.regexp_extract(text, insensitive, g), F.lit(""))
          for g in range(1, groups + 1)])
    return F.when(has_word(text, words), found) if words else found


def matches(text: Column, pattern: str, words: list[str] | None = None) -> Column:
    found = text.rlike("(?i)" + pattern)
    return has_word(text, words) & found if words else found


def first_rule(rules: list[tuple[Column, str]], default: Column) -> Column:
    """Ordered rules: the first condition that holds decides."""
    expr = default
    for condition, value in reversed(rules):
        expr = F.when(condition, F.lit(value)).otherwise(expr)
    return expr


def price(text: Column) -> Column:
    raw = first_group(text, C.PRICE_PATTERN, 2, C.PRICE_WORDS)
    return F.replace(raw, F.lit(","), F.lit("")).try_cast("double")


def payment_method(text: Column) -> Column:
    return first_rule(
        [(matches(text, p, C.PAYMENT_WORDS[level]), level) for level, p in C.PAYMENT_PATTERNS],
        F.lit(None).cast("string"))


def delivery_days(text: Column) -> Column:
    """"N days late" wins over "took N days"."""
    return F.coalesce(
        first_group(text, C.DELAY_PATTERN, words=C.DELAY_WORDS),
        first_group(text, C.TOOK_PATTERN, words=C.TOOK_WORDS)
    ).try_cast("bigint")


def order_id(text: Column) -> Column:
    return F.coalesce(
        first_group(text, C.ORDER_WORD_PATTERN, words=["order"]),
        first_group(text, C.ORDER_HASH_PATTERN, words=["#"])
    ).try_cast("bigint")


def weekend_flag(text: Column) -> Column:
    return F.when(matches(text, C.WEEKEND_PATTERN, ["week"]), 1).when(
        matches(text, C.WEEKDAY_PATTERN, ["week"]), 0)


def category_level(text: Column) -> Column:
    """A category named in the text, in catalog order of the levels."""
    order = ["Apparel", "Footwear", "Electronics", "Home", "Beauty"]
    lowered = F.lower(text)
    return first_rule(
        [(lowered.contains(c.lower()), c) for c in order], F.lit(None).cast("string"))


def slot_columns(text: Column) -> dict[str, Column]:
    """One column per order feature that can be read from free text."""
    slots = {
        "price_inr": price(text),
        "payment_method": payment_method(text),
        "delivery_days": delivery_days(text),
        "product_category": category_level(text),
    }
    for name, pattern, groups, kind in C.LABELLED_PATTERNS:
        slots[name] = first_group(text, pattern, groups, C.LABELLED_WORDS[name]).try_cast(kind)
    slots["is_weekend_order"] = weekend_flag(text)
    return slots


def slot_map(slots: dict[str, Column]) -> Column:
    """Only the features that were found, as a string map."""
    entries = F.array(*[
        F.struct(F.lit(name).alias("key"), value.cast("string").alias("value"))
        for name, value in slots.items()])
    return F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull()))


def merge_maps(left: Column, right: Column) -> Column:
    """Union of two maps; the right side wins on a shared key."""
    kept = F.map_filter(left, lambda k, _: ~F.map_contains_key(right, k))
    return F.map_concat(kept, right)


def injection_matches(text: Column) -> Column:
    """Every guard pattern that fires, with the matched words: array<struct<name, matched>>."""
    hits = F.array(*[
        F.struct(
            F.lit(name).alias("name"),
            F.regexp_extract(text, "(?i)" + pattern, 0).alias("matched"))
        for name, pattern in C.INJECTION_PATTERNS])
    return F.filter(hits, lambda h: h["matched"] != "")


def injection_blocked(text: Column) -> Column:
    """One alternation instead of 13 passes; true where any pattern fires."""
    return matches(text, "|".join(f"(?:{p})" for _, p in C.INJECTION_PATTERNS), C.INJECTION_WORDS)


def is_follow_up(text: Column) -> Column:
    """A short message that leans on a pronoun."""
    return (F.size(words(text)) <= C.FOLLOW_UP_MAX_WORDS) & matches(text, C.PRONOUN_PATTERN)


def with_topic(text: Column, topic: Column) -> Column:
    """Follow-ups get the remembered topic appended."""
    return F.when(
        topic.isNotNull() & is_follow_up(text), F.concat(text, F.lit(" ("), topic, F.lit(")"))
    ).otherwise(text)


def pick(key: Column, pool: list[str]) -> Column:
    """Deterministic choice: CRC-32 of the UTF-8 bytes modulo the pool size."""
    index = (F.crc32(F.encode(key, "UTF-8")) % len(pool) + 1).cast("int")
    return F.element_at(F.array(*[F.lit(p) for p in pool]), index)


def collapse_spaces(text: Column) -> Column:
    return strip(F.regexp_replace(text, r"\s+", " "))


def slugify(label: Column) -> Column:
    dashed = F.regexp_replace(F.lower(label), "[^a-z0-9]+", "_")
    return F.regexp_replace(dashed, "^_+|_+$", "")


def short_id(identifier: Column) -> Column:
    return F.substring_index(identifier, "_", 1)


def natural_list(items: Column) -> Column:
    """a, b and c."""
    n = F.size(items)
    head = F.array_join(F.slice(items, 1, F.greatest(n - 1, F.lit(0))), ", ")
    return F.when(n <= 1, F.array_join(items, "")).otherwise(
        F.concat(head, F.lit(" and "), F.element_at(items, -1)))


def percent(x: Column, digits: int = 2) -> Column:
    return F.format_string(f"%.{digits}f%%", x * 100)


def document_category(haystack: Column) -> Column:
    lowered = F.lower(haystack)
    rules = []
    for label, keywords in C.CATEGORY_KEYWORDS:
        found = lowered.contains(keywords[0])
        for k in keywords[1:]:
            found = found | lowered.contains(k)
        rules.append((found, label))
    return first_rule(rules, F.lit(C.DEFAULT_CATEGORY))
