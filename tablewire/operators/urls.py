"""Canonical URLs and label counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Scheme, authority and path of an absolute URL, up to the query or fragment.
URL = r"^([A-Za-z][A-Za-z0-9+.\-]*)://([^/]*)(/.*)?$"
# Name and password, host, and port of an authority.
AUTHORITY = r"^(?:(.*)@)?(\[[^\]]*\]|[^:@\[\]]*)(?::([0-9]*))?$"
# Schemes whose URLs have a host and a default port, and that port.
DEFAULT_PORTS = {"http": 80, "https": 443, "ws": 80, "wss": 443, "ftp": 21}
# Path segments that mean "here" and "one up", in lower case.
HERE = [".", "%2e"]
UP = ["..", ".%2e", "%2e.", "%2e%2e"]
# Characters that a path keeps only in percent-encoded form.
PATH_ENCODED = "[\\x00-\\x20\"#<>?`{}\\x7f-\\x{10ffff}]"
# Characters that a query keeps only in percent-encoded form.
QUERY_ENCODED = "[\\x00-\\x20\"#<>'\\x7f-\\x{10ffff}]"
# Fixed value: the service host whose first label is the region.
REGION = r"service\.([^.]+)\.([a-z]{4,10})\.[a-z]{6}(|-inc)\.com"


def _form_decoded(text: Column) -> Column:
    """``+`` is a space, ``%xx`` a byte; a stray percent sign stays as it is."""
    return F.url_decode(F.regexp_replace(text, "%(?![0-9A-Fa-f]{2})", "%25"))


def _percent_encoded(text: Column, characters: str) -> Column:
    def one(char: Column) -> Column:
        coded = F.regexp_replace(F.hex(F.encode(char, "UTF-8")), "(..)", "%$1")
        return F.when(char.rlike(characters), coded).otherwise(char)

    return F.when(
        text.rlike(characters), F.array_join(F.transform(F.split(text, ""), one), "")
    ).otherwise(text)


def _without_dots(path: Column) -> Column:
    """``path`` with the segments for "here" and "one up" resolved, by a fold with a stack of segments."""
    segments = F.split(path, "/")

    def meaning(segment: Column) -> Column:
        small = F.lower(segment)
        return F.when(small.isin(HERE), 1).when(small.isin(UP), 2).otherwise(0)

    def step(stack: Column, segment: Column) -> Column:
        up = F.when(F.size(stack) > 1, F.slice(stack, F.lit(1), F.size(stack) - 1)).otherwise(stack)
        what = meaning(segment)
        return F.when(what == 1, stack).when(what == 2, up).otherwise(F.concat(stack, F.array(segment)))

    # the text before the first slash is the bottom of the stack and never leaves it
    rest = F.slice(segments, F.lit(2), F.greatest(F.size(segments) - 1, F.lit(0)))
    folded = F.aggregate(rest, F.array(F.lit("")), step)
    open_end = F.when(meaning(F.element_at(segments, -1)) > 0, F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
    resolved = F.array_join(F.concat(folded, open_end), "/")
    return F.when(path.rlike(r"(?i)/(\.|%2e){1,2}(/|$)"), resolved).otherwise(path)


def _upper_escapes(text: Column) -> Column:
    """Percent escapes with upper-case digits."""

    def one(piece: Column, at: Column) -> Column:
        escape = F.concat(F.upper(F.substring(piece, 1, 2)), F.substring(piece, F.lit(3), F.length(piece)))
        return F.when((at > 0) & piece.rlike("^[0-9A-Fa-f]{2}"), escape).otherwise(piece)

    return F.when(
        text.rlike("%([a-f].|.[a-f])"), F.array_join(F.transform(F.split(text, "%"), one), "%")
    ).otherwise(text)


def _site(scheme: Column, authority: Column) -> Column:
    """The authority with a lower-case host and without a default port, or null if it is none."""
    user, host, port = (F.regexp_extract(authority, AUTHORITY, g) for g in (1, 2, 3))
    known = scheme.isin(list(DEFAULT_PORTS))
    number = F.regexp_replace(port, "^0+(?=[0-9])", "")
    default = F.element_at(F.create_map(*[F.lit(v) for pair in DEFAULT_PORTS.items() for v in (pair[0], str(pair[1]))]), scheme)
    shown = F.when((number == "") | F.coalesce(number == default, F.lit(False)), "").otherwise(F.concat(F.lit(":"), number))
    good = (
        authority.rlike(AUTHORITY)
        & ((F.length(number) < 5) | ((F.length(number) == 5) & (number <= "65535")))
        & (~known | (host != ""))
    )
    named = F.when(user == "", "").otherwise(F.concat(user, F.lit("@")))
    return F.when(good, F.concat(named, F.when(known, F.lower(host)).otherwise(host), shown))


def _pair(piece: Column, at: Column) -> Column:
    cut = F.instr(piece, "=")
    key = F.when(cut > 0, F.substring(piece, F.lit(1), cut - 1)).otherwise(piece)
    value = F.when(cut > 0, F.substring(piece, cut + 1, F.length(piece))).otherwise(F.lit(""))
    return F.struct(
        _form_decoded(key).alias("key"), at.alias("at"), _form_decoded(value).alias("value")
    )


def canonical_url(
    df: DataFrame, url_col: str, dedupe_by: str | Sequence[str] | None = None, upper_escapes: bool = False
) -> DataFrame:
    """Add ``site``, ``path``, ``canonical_query`` and ``canonical``.

    White space and control characters around the URL, and tabs and line ends in it,
    go. The host is in lower case and has no default port, backslashes are slashes
    (both for schemes with a host), segments for "here" and "one up" are resolved, and
    characters that a path cannot hold are percent-encoded. Escapes in a path keep
    their case, or become upper-case with ``upper_escapes``. Names in other scripts are
    not turned into their ASCII form.

    Query pairs are decoded, the last value of a key wins, keys are sorted
    bytewise, an empty value leaves the bare key.  ``canonical`` is the path with
    that query.  A text that is no absolute URL gives nulls.  ``dedupe_by`` keeps
    one row per site and canonical URL, the one with the smallest value there;
    rows without a URL are all kept.
    """
    url = F.regexp_replace(F.regexp_replace(F.col(url_col), "^[\\x00-\\x20]+|[\\x00-\\x20]+$", ""), "[\\t\\n\\r]", "")
    head = F.regexp_extract(url, "^[^?#]*", 0)
    scheme = F.lower(F.regexp_extract(head, "^([A-Za-z][A-Za-z0-9+.\\-]*):", 1))
    head = F.when(scheme.isin(list(DEFAULT_PORTS)), F.replace(head, F.lit("\\"), F.lit("/"))).otherwise(head)
    cut = df.select("*", url.alias("_url"), scheme.alias("_scheme"), head.alias("_head"))
    site = F.when(F.col("_head").rlike(URL), _site(F.col("_scheme"), F.regexp_extract("_head", URL, 2)))
    path = _percent_encoded(_without_dots(F.regexp_extract("_head", URL, 3)), PATH_ENCODED)
    cut = cut.select(*df.columns, "_url", "_head", site.alias("site"))
    good = F.col("site").isNotNull()
    split = cut.select(
        *df.columns,
        "site",
        F.when(good, _upper_escapes(path) if upper_escapes else path).alias("_path"),
        F.when(good, F.regexp_extract("_url", r"^[^?#]*(?:\?([^#]*))?", 1)).alias("_query"),
    )
    pieces = F.filter(F.split(F.col("_query"), "&"), lambda p: p != "")
    pairs = split.withColumn("_pairs", F.array_sort(F.transform(pieces, _pair)))
    shifted = F.slice(F.col("_pairs"), F.lit(2), F.greatest(F.size("_pairs"), F.lit(1)))
    flagged = F.zip_with(
        F.col("_pairs"),
        shifted,
        lambda own, nxt: F.struct(
            own["key"].alias("key"),
            own["value"].alias("value"),
            (nxt.isNull() | (nxt["key"] != own["key"])).alias("last"),
        ),
    )
    last = F.filter(flagged, lambda p: p["last"])
    shown = F.transform(
        last,
        lambda p: F.when(p["value"] == "", p["key"]).otherwise(
            F.concat(p["key"], F.lit("="), p["value"])
        ),
    )
    out = pairs.select(
        *df.columns,
        "site",
        F.when(F.col("_path") == "", F.lit("/")).otherwise(F.col("_path")).alias("path"),
        F.array_join(shown, "&").alias("_joined"),
    ).select(
        *df.columns, "site", "path", _percent_encoded(F.col("_joined"), QUERY_ENCODED).alias("canonical_query")
    )
    out = out.withColumn(
        "canonical",
        F.when(F.col("canonical_query") == "", F.col("path")).otherwise(
            F.concat("path", F.lit("?"), "canonical_query")
        ),
    )
    if dedupe_by is None:
        return out
    by = [dedupe_by] if isinstance(dedupe_by, str) else list(dedupe_by)
    # The smallest struct per group is found on the map side first, so a URL that
    # holds much of the table costs one row per task.  Rows without a URL keep
    # their own id as a group key and stay apart.
    alone = F.when(F.col("canonical").isNull(), F.struct(*by))
    whole = F.struct(*[F.col(f"`{c}`") for c in out.columns])
    return (
        out.groupBy("site", "canonical", alone.alias("_alone"))
        .agg(F.min_by(whole, F.struct(*by)).alias("_kept"))
        .select(*[F.col("_kept").getField(c).alias(c) for c in out.columns])
    )


def label_counts(df: DataFrame, col: str, pattern: str = REGION, group: int = 1) -> DataFrame:
    """``(label, n, n_unmatched)``: rows per captured label.

    Rows that do not match are counted in the row whose label is null.
    """
    label = F.nullif(F.regexp_extract(F.col(col), pattern, group), F.lit(""))
    counted = df.groupBy(label.alias("label")).agg(F.count(F.lit(1)).alias("_rows"))
    unmatched = F.col("label").isNull()
    return counted.select(
        "label",
        F.when(unmatched, 0).otherwise(F.col("_rows")).cast("long").alias("n"),
        F.when(unmatched, F.col("_rows")).otherwise(0).cast("long").alias("n_unmatched"),
    )
