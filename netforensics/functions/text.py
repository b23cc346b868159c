"""Text Columns: entropy, names, hosts and n-grams."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from netforensics.functions.ip import is_ip_literal


def blank_to_null(value: Column) -> Column:
    """Log placeholders and the empty text become NULL."""
    return F.when(~value.isin("-", "(empty)", ""), value)


def characters(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def entropy(text: Column) -> Column:
    """Shannon entropy of the characters, base 2; 0.0 for an empty text."""
    size = F.length(text).cast("double")

    def step(total: Column, char: Column) -> Column:
        share = (size - F.length(F.replace(text, char, F.lit("")))) / size
        return total - share * F.log2(share)

    return F.aggregate(F.array_distinct(characters(text)), F.lit(0.0), step)


def label_count(name: Column) -> Column:
    return F.length(name) - F.length(F.replace(name, F.lit("."), F.lit(""))) + 1


def registered_domain(name: Column) -> Column:
    """The last two labels (the name itself when it has fewer)."""
    return F.substring_index(name, ".", -2)


def subdomain(name: Column) -> Column:
    """Everything before the last two labels, '' when there is nothing."""
    rest = F.length(name) - F.length(registered_domain(name)) - 1
    return F.when(label_count(name) > 2, F.substr(name, F.lit(1), rest)).otherwise(F.lit(""))


def first_label(name: Column) -> Column:
    return F.substring_index(name, ".", 1)


def clean_name(name: Column) -> Column:
    """Lower case without trailing dots."""
    return F.rtrim(F.lower(name), F.lit("."))


def name_suffixes(name: Column, min_labels: int = 1) -> Column:
    """The name and each of its parents with at least `min_labels` labels, longest first."""
    labels = F.split(name, r"\.")
    last = F.size(labels) - (min_labels - 1)
    return F.when(
        last >= 1,
        F.transform(
            F.sequence(F.lit(1), last),
            lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
        ),
    ).otherwise(F.array().cast("array<string>"))


def host_header_domain(raw: Column) -> Column:
    """A domain name from a Host header; NULL for addresses, dotless names and blanks."""
    host = F.lower(F.rtrim(F.trim(raw), F.lit(".")))
    colons = F.length(host) - F.length(F.replace(host, F.lit(":"), F.lit("")))
    bare = (
        F.when(host.startswith("["), F.substring_index(F.substr(host, F.lit(2)), "]", 1))
        .when(colons == 1, F.substring_index(host, ":", 1))
        .otherwise(host)
    )
    return F.when(~is_ip_literal(bare) & bare.contains("."), bare)


def url_host(url: Column) -> Column:
    """Lower-case host of a URL without user info or port; NULL when there is none."""
    rest = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)
    authority = F.regexp_replace(rest, r"^.*@", "")
    bracketed = F.regexp_extract(authority, r"^\[([^\]]*)\]", 1)
    plain = F.substring_index(authority, ":", 1)
    host = F.lower(F.when(authority.startswith("["), bracketed).otherwise(plain))
    return F.when(host != "", host)


def char_ngrams(text: Column) -> Column:
    """Boundary-marked character bigrams then trigrams."""
    marked = F.concat(F.lit("^"), text, F.lit("$"))
    size = F.length(marked)

    def grams(n: int) -> Column:
        return F.when(
            size >= n,
            F.transform(F.sequence(F.lit(1), size - (n - 1)), lambda i: F.substr(marked, i, F.lit(n))),
        ).otherwise(F.array().cast("array<string>"))

    return F.concat(grams(2), grams(3))


def count_matching(text: Column, pattern: str) -> Column:
    """Number of characters of `text` that match the one-character pattern."""
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def longest_run(text: Column, pattern: str) -> Column:
    """Length of the longest match of `pattern`, 0 when none."""
    runs = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))
    return F.coalesce(F.array_max(F.transform(runs, F.length)), F.lit(0))
