"""Secret scans with corpus-wide ownership frequency [native].

Candidates are found by pattern in every whole text. Their values are hashed, and each hash is counted
over the corpus by distinct owners and distinct repositories. A value that many owners hold, or one
that a single owner spread over many repositories, is a copied example; a live-looking value that a single owner
holds in few repositories is that owner's credential. The base kinds (assign, access, hex) are always
reported; a bare token without a keyword beside it is added, as kind ``owned``, only if it is an owner's
credential.

Positions come from ``split`` and ``regexp_extract_all`` by the same pattern: the pieces between the
matches and the matches themselves tile the text, so running sums of their lengths are code point
offsets. The sums are windows over the few matches of a document, never over texts.

Defined cases: a null text is empty and has no spans; a null owner counts as one owner of that name,
a null repository likewise; equal rows count as one repository; no rows give no rows; extra columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickerloom.llm.common import fresh, materialise

# The base patterns, in the order in which kinds are listed.
ASSIGN = (
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"  # runs of [0-9a-f] of 24 characters or more
TOKEN = r"[A-Za-z0-9+/_=-]{20,}"
KINDS = ("assign", "access", "hex", "owned")
#: Fewer distinct characters than this don't look like a credential.
LIVE_CHARS = 10
#: A value held by so many owners or more, or in so many repositories or more, is a copied example. An owner
#: may well paste a live credential into a few places of their own, so the second bound is the wider one.
EXAMPLE_OWNERS, EXAMPLE_REPOSITORIES = 3, 10

c = F.col


def looks_live(value: Column) -> Column:
    """Upper and lower case letters, digits, and at least :data:`LIVE_CHARS` distinct characters."""
    mixed = value.rlike("[0-9]") & value.rlike("[a-z]") & value.rlike("[A-Z]")
    return mixed & (F.size(F.array_distinct(F.split(value, ""))) >= LIVE_CHARS)


def _tiles(kind: int, pattern: str, group: int) -> Column:
    """Per match of one kind: order, length of the piece before it, its length, its value."""
    text, lit = c("text"), F.lit(pattern)
    found = [F.split(text, pattern, -1), F.regexp_extract_all(text, lit, F.lit(0))]
    if group:
        found.append(F.regexp_extract_all(text, lit, F.lit(group)))
    tiles = F.transform(
        F.arrays_zip(*(x.alias(n) for x, n in zip(found, ("piece", "match", "value"), strict=False))),
        lambda t, i: F.struct(
            F.lit(kind).alias("kind"), i.alias("turn"), F.length(t["piece"]).alias("gap"), F.length(t["match"]).alias("len"),
            (t["value"] if group else t["match"]).alias("value"),
        ),
    )
    # the last piece has no match behind it
    return F.when(text.rlike(pattern), F.filter(tiles, lambda t: t["len"].isNotNull()))


def _matches() -> Column:
    """All kinds' matches in ``text``, with the pieces before them (a null text has none)."""
    none = F.array().cast("array<struct<kind:int,turn:int,gap:int,len:int,value:string>>")
    kinds = [_tiles(0, ASSIGN, 2), _tiles(1, ACCESS, 0), _tiles(2, HEX, 0), _tiles(3, TOKEN, 0)]
    return F.concat(*(F.coalesce(k, none) for k in kinds))


def candidates(docs: DataFrame, repository: Column, owner: Column) -> DataFrame:
    """Every match in every document: id (of the row), doc_id, owner, repository, kind, start, end, value_hash, live.

    A document without any match has one row without a kind. Matches that fail their kind's check are
    gone: an assigned value has 6 characters, an access key 20, a token looks live.
    """
    slim = docs.select(
        "doc_id", F.coalesce(c("text"), F.lit("")).alias("text"), owner.cast("string").alias("owner"), repository.cast("string").alias("repository"),
        F.monotonically_increasing_id().alias("id"),
    )
    return _checked(slim.select("id", "doc_id", "owner", "repository", F.explode_outer(_matches()).alias("m")))


def _checked(found: DataFrame) -> DataFrame:
    """The matches ``m`` that pass their kind's check, with their places."""
    # the value itself isn't written here, only its hash and what the checks need
    found = materialise(
        found.select("id", "doc_id", "owner", "repository", "m.*").select(
            "id", "doc_id", "owner", "repository", "kind", "turn", "gap", "len",
            F.sha2("value", 256).alias("value_hash"), F.length("value").alias("value_len"), looks_live(c("value")).alias("live"),
        )
    )
    upto = W.partitionBy("id", "kind").orderBy("turn").rowsBetween(W.unboundedPreceding, 0)
    found = found.withColumn("end", F.sum(c("gap") + c("len")).over(upto)).withColumn("start", c("end") - c("len"))
    keep = c("kind").isNull() | ((c("kind") == 0) & (c("value_len") >= 6)) | ((c("kind") == 1) & (c("len") >= 20)) | (c("kind") == 2)
    kept = keep | ((c("kind") == 3) & c("live"))
    # a document whose matches all fail still needs a row
    first = F.row_number().over(W.partitionBy("id").orderBy(kept.desc(), "kind", "turn")) == 1
    found = found.withColumns({"kept": kept, "first": first}).filter(c("kept") | c("first"))
    blank = ["kind", "start", "end", "value_hash", "live"]
    return found.select("id", "doc_id", "owner", "repository", *(F.when(c("kept"), c(n)).alias(n) for n in blank))


def ownership(found: DataFrame) -> DataFrame:
    """Per candidate hash: owners and repositories, both distinct.

    Repeats are dropped by (hash, owner, repository) before anything meets by hash alone, and counts are
    combined on the map side, so a value that a third of all rows hold fills no task.
    """
    held = found.filter(c("value_hash").isNotNull()).groupBy("value_hash", "owner", "repository").agg(F.max("live").alias("live"))
    per_owner = held.groupBy("value_hash", "owner").agg(F.count("*").alias("repositories"), F.max("live").alias("live"))
    return per_owner.groupBy("value_hash").agg(
        F.count("*").alias("owners"), F.sum("repositories").alias("repositories"), F.max("live").alias("live")
    )


def owner_specific() -> Column:
    """True for a value that one owner holds in few repositories."""
    return (c("owners") == 1) & (c("repositories") < EXAMPLE_REPOSITORIES)


def copied_example() -> Column:
    """True for a value of many owners or many repositories."""
    return (c("owners") >= EXAMPLE_OWNERS) | (c("repositories") >= EXAMPLE_REPOSITORIES)


def spans(docs: DataFrame, repository: Column, owner: Column) -> DataFrame:
    """All spans to report, one row each (documents without one keep a row without a kind).

    ``owners`` and ``repositories`` are those of the span's value. An added span overlaps no base span.
    """
    return _judged(materialise(candidates(docs, repository, owner)))


def _judged(found: DataFrame) -> DataFrame:
    known = ownership(found).select("value_hash", "owners", "repositories")
    held = c("value_hash").isNotNull()
    judged = found.filter(held).join(known, "value_hash", "left").drop("owner", "repository")
    # documents without a candidate have no hash to meet by
    judged = judged.unionByName(found.filter(~held).drop("owner", "repository"), allowMissingColumns=True)
    base = c("kind") < 3
    by_start = W.partitionBy("id").orderBy("start", "kind")
    before = F.max(F.when(base, c("end"))).over(by_start.rowsBetween(W.unboundedPreceding, 0))
    after = F.min(F.when(base, c("start"))).over(W.partitionBy("id").orderBy(c("start").desc(), c("kind").desc()).rowsBetween(W.unboundedPreceding, 0))
    judged = judged.withColumns({"before": before, "after": after})
    apart = F.coalesce(c("before") <= c("start"), F.lit(True)) & F.coalesce(c("after") >= c("end"), F.lit(True))
    added = (c("kind") == 3) & owner_specific() & apart
    # others lose their span but keep the document's row
    keep = c("kind").isNotNull() & (base | added)
    blank = ["kind", "start", "end", "owners", "repositories", "live"]
    return judged.select("id", "doc_id", *(F.when(keep, c(n)).alias(n) for n in blank))


def _joined(items: Column) -> Column:
    """``kind:start:end`` of the spans by start, then kind, comma-joined."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.concat_ws(",", F.transform(F.array_sort(items), lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])))


def scan(docs: DataFrame, repository: Column, owner: Column) -> DataFrame:
    """Per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_owner_specific, n_copied_examples, most_repositories.

    The last three are of the reported spans: those of owner-specific live-looking values, those of copied
    examples, and the most repositories that hold one of their values (0: no span).
    """
    found = spans(docs, repository, owner)
    n = lambda when: F.count(F.when(when, 1)).cast("long")
    place = F.struct("start", "kind", "end")
    grouped = found.groupBy("id").agg(
        F.first("doc_id").alias("doc_id"),
        *(n(c("kind") == k).alias(f"n_{KINDS[k]}") for k in range(3)),
        F.collect_list(F.when(c("kind").isNotNull(), place)).alias("all"),
        n(owner_specific() & c("live")).alias("n_owner_specific"),
        n(copied_example()).alias("n_copied_examples"),
        F.coalesce(F.max("repositories"), F.lit(0)).cast("long").alias("most_repositories"),
    )
    base = F.filter("all", lambda s: s["kind"] < 3)
    return grouped.select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2(_joined(base), 256).alias("base_sha256"), _joined(c("all")).alias("spans"),
        "n_owner_specific", "n_copied_examples", "most_repositories",
    )


def mask(docs: DataFrame, repository: Column, owner: Column, fill: str = "[SECRET]") -> DataFrame:
    """``docs`` with every reported span replaced by ``fill`` and n_chars counted anew where texts changed.

    Texts are searched once: the documents are written with their matches beside them. Only those that
    hold a match are joined with their spans, by the number of the row; the others never move.
    """
    row, matches, cuts = (fresh(x, docs.columns) for x in ("row", "matches", "cuts"))
    marked = materialise(docs.withColumns({row: F.monotonically_increasing_id(), matches: _matches()}))
    hit = F.size(matches) > 0
    found = marked.filter(hit).select(
        c(row).alias("id"), "doc_id", owner.cast("string").alias("owner"), repository.cast("string").alias("repository"), F.explode(matches).alias("m")
    )
    found = _judged(materialise(_checked(found))).filter(c("kind").isNotNull())
    lists = found.groupBy(c("id").alias(row)).agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias(cuts))
    joined = marked.filter(hit).join(lists, row, "left")
    state = F.aggregate(
        c(cuts),
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<a:int,b:int>>").alias("keep")),
        lambda acc, s: F.struct(
            F.greatest(acc["at"], s["end"].cast("int")).alias("at"),
            F.when(
                s["start"] >= acc["at"],
                F.concat(acc["keep"], F.array(F.struct(acc["at"].alias("a"), s["start"].cast("int").alias("b")))),
            ).otherwise(acc["keep"]).alias("keep"),
        ),
    )
    state = F.concat(state["keep"], F.array(F.struct(state["at"].alias("a"), F.length("text").alias("b"))))
    text = F.concat_ws(fill, F.transform(state, lambda k: F.substring(c("text"), k["a"] + 1, k["b"] - k["a"])))
    joined = joined.withColumn("text", F.when(c(cuts).isNotNull(), text).otherwise(c("text")))
    if "n_chars" in docs.columns:
        joined = joined.withColumn("n_chars", F.when(c(cuts).isNotNull(), F.length("text").cast("long")).otherwise(c("n_chars")))
    columns = [c(f"`{n}`") for n in docs.columns]
    return marked.filter(~hit).select(*columns).unionByName(joined.select(*columns))
