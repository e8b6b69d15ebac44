"""Secret scan with multipart credential linking, in DataFrame functions only.

Base kinds (always reported): ``assign`` (a secret-like name, a separator and a value of 12+ characters),
``access`` (AKIA..., 18+) and ``hex`` (16+). The linking step adds weak parts: short assigned secrets
(6 to 11 characters), named identifiers (user, client id, account) and endpoints (URLs, host settings).
Parts are intervals; two parts are linked when they lie in one scope (at most ``scope`` code points
between them in the same text). The interval join looks, per part, only at the nearest part of each
role on either side, which decides whether any lies in scope without forming pairs. A weak secret is
reported next to an identifier or an endpoint, a weak identifier or an endpoint next to a secret. Parts that are
linked directly or through one another form a group.

Defined cases: null text is empty (no spans); repeated rows are reported once each; an empty table gives no
rows; positions are code points, end exclusive, and a text of any length is scanned whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# The patterns and least lengths of the base kinds, then those of the linked parts.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{16,}"
IDENT = r"""(?i)(?:user(?:name)?|login|client_?id|account(?:_?id)?)["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.@-]{3,})"""
ENDPOINT = r"""(?i)(?:[a-z][a-z0-9+.-]{1,20}://[A-Za-z0-9._~:/?#@%&=+-]+|(?:host|endpoint|server)["']?\x20*[:=]\x20*["']?[A-Za-z0-9.-]{4,})"""
KINDS = ("assign", "access", "hex", "weak_secret", "identifier", "endpoint")
SCOPE = 200
CHUNK = 256

_PART = "array<struct<start:int,ord:int,end:int,role:string,base:boolean>>"


def _let(value: Column, body) -> Column:
    """body(value) with value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _starts(steps: Column) -> Column:
    """Start of each match from the lengths of gaps and matches: sums inside chunks, then the chunks' own sums.

    An array that grows in a fold is copied at every step, so none grows past CHUNK or the number of chunks."""
    def chunk(c):
        return F.aggregate(
            F.slice(steps, c * CHUNK + 1, F.lit(CHUNK)),
            F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts")),
            lambda acc, x: F.struct((acc["at"] + x["gap"] + x["len"]).alias("at"),
                                    F.concat(acc["starts"], F.array(acc["at"] + x["gap"])).alias("starts")))

    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / CHUNK).cast("int")), chunk)
    return _let(chunks, lambda all_: _let(
        F.aggregate(all_, F.array(F.lit(0)), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x["at"]))),
        lambda before: F.flatten(F.transform(all_, lambda x, i: F.transform(x["starts"], lambda s: s + F.get(before, i))))))


def _found(text: Column, pattern: str, part) -> Column:
    """Parts of all leftmost non-overlapping matches: the gaps and the matches add up to positions."""
    def placed(hits):
        steps = F.transform(F.arrays_zip(F.transform(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(hits)), F.length).alias("gap"),
                                         hits.alias("hit")), lambda x: F.struct(x["gap"].alias("gap"), F.length(x["hit"]).alias("len")))
        return F.flatten(F.transform(F.arrays_zip(_let(steps, _starts).alias("start"), hits.alias("hit")),
                                     lambda x: part(x["hit"], x["start"])))
    return F.when(text.rlike(pattern), _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)) \
        .otherwise(F.array().cast(_PART))


def _one(hit: Column, start: Column, kind: str, role: str, base: bool) -> Column:
    return F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("ord"),
                    (start + F.length(hit)).alias("end"), F.lit(role).alias("role"), F.lit(base).alias("base"))


def _assign_part(hit: Column, start: Column) -> Column:
    n = F.length(F.regexp_extract(hit, ASSIGN, 2))
    return (F.when(n >= 12, F.array(_one(hit, start, "assign", "secret", True)))
            .when(n >= 6, F.array(_one(hit, start, "weak_secret", "secret", False)))
            .otherwise(F.array().cast(_PART)))


def _part_of(kind: str, role: str, base: bool, least: int = 0):
    return lambda hit, start: F.when(F.length(hit) >= least, F.array(_one(hit, start, kind, role, base))) \
        .otherwise(F.array().cast(_PART))


def parts(text: Column) -> Column:
    """All parts of a text: base spans and weak ones, unlinked."""
    return F.concat(_found(text, ASSIGN, _assign_part), _found(text, ACCESS, _part_of("access", "identifier", True, 18)),
                    _found(text, HEX, _part_of("hex", "secret", True)),
                    _found(text, IDENT, _part_of("identifier", "identifier", False)),
                    _found(text, ENDPOINT, _part_of("endpoint", "endpoint", False)))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", s["group"], F.get(F.array(*[F.lit(k) for k in KINDS]), s["ord"]), s["start"], s["end"])), ",")


def scan(docs: DataFrame, keep: list[str], scope: int = SCOPE) -> DataFrame:
    """One row per row of docs: keep columns, n_assign, n_access, n_hex, base_sha256, spans, links.

    ``links`` lists the parts that have a complementary part in scope as group:kind:start:end; linked parts at most
    ``scope`` apart share a group, numbered from 1 in the order of the text.
    """
    # the row number comes before the parts are spread out, in a select of its own
    found = docs.select(F.monotonically_increasing_id().alias("_rid"), F.struct(*keep).alias("_keep"),
                        parts(F.coalesce(F.col("text"), F.lit(""))).alias("_parts"))
    flat = found.select("_rid", "_keep", F.explode_outer("_parts").alias("_p")).select("_rid", "_keep", "_p.*")
    order, back = ["start", "end", "ord"], [F.desc("start"), F.desc("end"), F.desc("ord")]
    ahead = Window.partitionBy("_rid").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    behind = Window.partitionBy("_rid").orderBy(*back).rowsBetween(Window.unboundedPreceding, -1)

    def near(*roles):
        this = F.col("role").isin(*roles)
        before = F.max(F.when(this, F.col("end"))).over(ahead)
        after = F.min(F.when(this, F.col("start"))).over(behind)
        return F.coalesce(F.col("start") - before <= scope, F.lit(False)) | \
            F.coalesce(after - F.col("end") <= scope, F.lit(False))

    near_by = flat.withColumn("_other", near("identifier", "endpoint")).withColumn("_secret", near("secret"))
    linked = near_by.withColumn("_linked", F.when(F.col("role") == "secret", F.col("_other")).otherwise(F.col("_secret")))
    # gaps and islands over the linked parts: one opens a group if the linked parts before it end out of scope
    reach = F.max(F.when(F.col("_linked"), F.col("end"))).over(ahead)
    opens = F.col("_linked") & F.coalesce(F.col("start") - reach > scope, F.lit(True))
    grouped = linked.withColumn("_opens", F.when(opens, 1).otherwise(0)).withColumn(
        "_group", F.sum("_opens").over(ahead.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    here = F.col("start").isNotNull()
    span = lambda group: F.struct("start", "ord", "end", "base", group.alias("group"))
    kept = grouped.groupBy("_rid").agg(
        F.first("_keep").alias("_keep"),
        F.collect_list(F.when(here & (F.col("base") | F.col("_linked")), span(F.lit(None).cast("long")))).alias("_all"),
        F.collect_list(F.when(here & F.col("_linked"), span(F.col("_group")))).alias("_links"))
    base = F.filter("_all", lambda s: s["base"])
    count = lambda kind: F.size(F.filter("_all", lambda s: s["ord"] == KINDS.index(kind))).cast("long")
    return kept.select("_keep.*", count("assign").alias("n_assign"), count("access").alias("n_access"),
                       count("hex").alias("n_hex"), F.sha2(_joined(base), 256).alias("base_sha256"),
                       _joined(F.col("_all")).alias("spans"), _joined(F.col("_links")).alias("links"))
