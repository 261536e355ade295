"""String and path expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.functions.columns import as_col

# Characters replaced in file names, and characters kept.
UNSAFE_NAME_CHARS = '<>:"/\\|?*'
DROPPED_NAME_CHARS = r"[^\p{L}\p{N}_\s.\-]"


def base_name(path) -> Column:
    return F.substring_index(as_col(path), "/", -1)


def parent_dir(path) -> Column:
    return F.regexp_extract(F.rtrim(as_col(path), F.lit("/")), r"^(.*)/[^/]*$", 1)


def extension(path) -> Column:
    """Lower-case extension with its dot, or '' (a leading dot does not count)."""
    return F.lower(F.regexp_extract(base_name(path), r"[^.].*?(\.[^.]*)$", 1))


def normalise_path(path, scheme: str, root: str) -> Column:
    """Strip a leading ``scheme`` and put the path under ``root``."""
    path = as_col(path)
    bare = F.when(
        path.startswith(scheme), F.substring(path, len(scheme) + 1, 2**31 - 1)
    ).otherwise(path)
    root = root.rstrip("/")
    return (
        F.when(bare.startswith(root + "/"), bare)
        .when(bare.startswith("/"), F.concat(F.lit(root), bare))
        .otherwise(F.concat(F.lit(root + "/"), bare))
    )


def safe_file_name(name) -> Column:
    marked = F.translate(as_col(name), UNSAFE_NAME_CHARS, "_" * len(UNSAFE_NAME_CHARS))
    kept = F.regexp_replace(marked, DROPPED_NAME_CHARS, "")
    return F.trim(F.regexp_replace(kept, r"\s+", "_"))


def paper_file_name(year, authors, item_id, title) -> Column:
    return F.concat(
        F.concat_ws(
            "_",
            as_col(year),
            F.substring_index(as_col(authors), " et al.", 1),
            as_col(item_id),
            safe_file_name(title),
        ),
        F.lit(".pdf"),
    )


def report_file_name(ticker, company, period: str = "FY24") -> Column:
    return F.concat(
        F.lit(f"{period}_"),
        as_col(ticker),
        F.lit("_"),
        safe_file_name(company),
        F.lit("_Annual_Report.pdf"),
    )


def owner_key(email, strict: bool = True) -> Column:
    """Part before ``@`` with dots as underscores; no ``@`` fails or gives NULL."""
    email = as_col(email)
    key = F.translate(F.substring_index(email, "@", 1), ".", "_")
    if strict:
        bad = F.raise_error(F.concat(F.lit("not an email address: "), email)).cast("string")
        return F.when(email.isNull() | email.contains("@"), key).otherwise(bad)
    return F.when(email.contains("@"), key)


def url_origin(url) -> Column:
    url = as_col(url)
    return F.concat(
        F.try_parse_url(url, F.lit("PROTOCOL")),
        F.lit("://"),
        F.try_parse_url(url, F.lit("AUTHORITY")),
        F.lit("/"),
    )


def url_host(url) -> Column:
    return F.try_parse_url(as_col(url), F.lit("HOST"))


def words(text) -> Column:
    """Lower-case whitespace-separated words, without empty ones."""
    return F.filter(F.split(F.lower(as_col(text)), r"\s+"), lambda w: w != "")


def is_term(word) -> Column:
    """All letters and longer than four characters."""
    word = as_col(word)
    return (F.length(word) > 4) & word.rlike(r"^\p{L}+$")


def contains_any(text, keywords: list[str], whole_words: bool = False) -> Column:
    """Some keyword occurs in ``text``, ignoring case."""
    low = F.lower(as_col(text))
    hit = F.lit(False)
    for word in keywords:
        if whole_words:
            hit = hit | low.rlike(rf"(?<![\p{{L}}\p{{N}}]){word.lower()}(?![\p{{L}}\p{{N}}])")
        else:
            hit = hit | low.contains(word.lower())
    return hit


def preview(text, size: int = 200, ellipsis: str = "") -> Column:
    """First ``size`` characters, with ``ellipsis`` when something was cut."""
    text = as_col(text).cast("string")
    head = F.substring(text, 1, size)
    if not ellipsis:
        return head
    return F.when(F.length(text) > size, F.concat(head, F.lit(ellipsis))).otherwise(text)


def first_filled(*columns) -> Column:
    """First column that is neither NULL nor empty."""
    return F.coalesce(*[F.nullif(as_col(c), F.lit("")) for c in columns])


def title_case(text) -> Column:
    return F.initcap(F.translate(as_col(text), "_", " "))


def thousands(number, digits: int = 0) -> Column:
    return F.format_number(as_col(number), digits)
