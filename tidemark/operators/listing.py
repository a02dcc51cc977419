"""Triggered listings: many parametrised listings in one join, routed by outcome."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.paths import depth, normalise_path, relative_dir
from tidemark.functions.templates import full_match, pattern_compiles, render, resolve_filter, wrap_full
from tidemark.functions.values import error_attributes, merge_attributes, root_cause
from tidemark.operators.incremental import fingerprint
from tidemark.operators.patterns import contained, head_lengths, headed, literals_of, with_head, with_literal
from tidemark.operators.predicates import FilterSpec, apply_filters
from tidemark.plans.joins import DEFAULT_LIMIT, BroadcastLimit, join_checked, measure, row_bytes
from tidemark.plans.nested import fits, locate, nest
from tidemark.plans.storage import stage, task_count
from tidemark.schema import FAILURE, NO_FILES, SUCCESS

# Up to this many different patterns are written into the plan as constants.
CONSTANT_PATTERNS = 64
# With more folder depths or prefix lengths than this, files are put at their deepest prefix instead of being copied.
COPIED_LEVELS = 4
# Places that triggers look at are broadcast as hashes of 8 bytes if they are too many or too long as they are.
PLACES = BroadcastLimit(rows=4_000_000)
# With more triggers per listing than this, its files are dealt to more tasks, up to so many.
ASKERS_PER_TASK = 50
MAX_TASKS = 4_000
# What a listing is made of; triggers that agree in all of it share the listing.
SETTINGS = ("t_container", "t_directory", "t_prefix", "t_file", "t_path")


@dataclass(frozen=True)
class ListingTemplates:
    """Templates of one kind of listing, resolved per trigger.

    ``directory`` scopes by folder (file servers, data lake), ``prefix`` by raw
    key prefix (object store); give at most one.  ``relative_paths`` makes the
    path filter see the part of the directory below ``directory``.
    """

    container: str
    directory: str | None = None
    prefix: str | None = None
    recursive: bool = True
    file_filter: str | None = None
    path_filter: str | None = None
    no_trigger: str = "render"
    relative_paths: bool = False


def resolve_triggers(triggers: DataFrame, templates: ListingTemplates) -> DataFrame:
    """Add the resolved settings (``t_…``), ``t_anchor`` and the pattern check ``is_valid``."""
    if templates.directory is not None and templates.prefix is not None:
        raise ValueError("give a directory or a prefix, not both")
    attrs, none = F.col("attrs"), F.lit(None).cast("string")
    out = triggers.withColumns({
        "t_container": render(templates.container, attrs),
        "t_directory": none if templates.directory is None else normalise_path(render(templates.directory, attrs)),
        "t_prefix": none if templates.prefix is None else render(templates.prefix, attrs),
        "t_file": resolve_filter(templates.file_filter, attrs, templates.no_trigger),
        "t_path": resolve_filter(templates.path_filter, attrs, templates.no_trigger),
    })
    if templates.prefix is not None:
        anchor = F.coalesce(F.col("t_prefix"), F.lit(""))
    elif templates.directory is not None:
        anchor = F.col("t_directory")
    else:
        anchor = F.lit("")
    ok = [F.col(c).isNull() | pattern_compiles(F.col(c)) for c in ("t_file", "t_path")]
    return out.withColumns({
        "t_anchor": anchor if templates.prefix is not None else F.trim(anchor, F.lit("/")),
        "is_valid": F.coalesce(ok[0] & ok[1], F.lit(False)),
    })


@dataclass(frozen=True)
class _Facts:
    """What is known about a trigger table before the join is planned."""

    fits: bool
    depths: list[int]
    files: list[str] | None
    paths: list[str] | None


def _facts(t: DataFrame, limit: BroadcastLimit, level: Callable[[Column], Column]) -> _Facts:
    """Measure a trigger table: size, levels of its anchors, and its patterns if they are few.

    One job over at most ``limit.rows + 1`` rows; a larger table takes further
    ones for its levels (folder depths or prefix lengths) and its patterns, of which
    no more come back than may become constants.
    """
    few = CONSTANT_PATTERNS + 1
    depths = F.collect_set(level(F.col("t_anchor")))
    n, size, levels, files, paths = t.limit(limit.rows + 1).agg(
        F.count(F.lit(1)), F.coalesce(F.sum(row_bytes(t)), F.lit(0)), depths,
        F.slice(F.collect_set("t_file"), 1, few), F.slice(F.collect_set("t_path"), 1, few)).first()
    fits = n <= limit.rows and size <= limit.bytes
    if n > limit.rows:
        levels = t.agg(depths).first()[0]
        files, paths = [[r[0] for r in t.select(c).where(F.col(c).isNotNull()).distinct().limit(few).collect()]
                        for c in ("t_file", "t_path")]
    return _Facts(fits, sorted(levels),
                  files if len(files) < few else None, paths if len(paths) < few else None)


def _coded(pattern: Column, known: list[str] | None) -> Column:
    """A pattern as its place among the known ones, or as text ready to run."""
    if known is None:
        return wrap_full(pattern)
    if not known:
        return F.lit(None).cast("int")
    return F.when(pattern.isNotNull(), F.array_position(F.array(*[F.lit(p) for p in known]), pattern).cast("int"))


def _matches(text: Column, code: Column, known: list[str] | None) -> Column:
    """Pattern test per row.

    Known patterns are constants of the plan, compiled once per task.  Otherwise
    each row brings its own, recompiled when it differs from the row before.
    """
    if known is None:
        return code.isNull() | (F.regexp_instr(text, code) > 0)
    branch = F.when(code.isNull(), F.lit(True))
    for i, p in enumerate(known, 1):
        branch = branch.when(code == i, full_match(text, p))
    return branch.otherwise(F.lit(False))


def _at_depth(directory: Column, level: int) -> Column:
    return F.lit("") if level == 0 else F.substring_index(directory, "/", level)


def _anchored(inv: DataFrame, levels: list[int], prefixes: bool) -> DataFrame:
    """Add ``t_anchor``: the file's folder cut to each depth, or its path cut to each prefix length, of a trigger.

    With one level this is a plain column; with more, a file appears once per
    level that it reaches.  Triggers then meet only files below their folder or
    with their prefix.
    """
    if levels == [0]:
        return inv.withColumn("t_anchor", F.lit(""))
    path, clean = F.col("full_path"), F.trim(F.col("directory"), F.lit("/"))
    if len(levels) > COPIED_LEVELS:
        long = F.char_length(path) if prefixes else depth(clean)
        reached = F.filter(F.array(*[F.lit(n) for n in levels]), lambda n: n <= long)
        n = F.col("_level")
        cut = F.substring(path, F.lit(1), n) if prefixes else F.call_function("substring_index", clean, F.lit("/"), n)
        # Files are dealt to all tasks first: each is looked up at hundreds of places, however few tasks read the inventory.
        dealt = inv.repartition(task_count(inv.sparkSession))
        return dealt.withColumn("_level", F.explode(reached)).withColumn("t_anchor", cut).drop("_level")
    if prefixes:
        reach = [F.when(F.char_length(path) >= n, F.substring(path, 1, n)) for n in levels]
    else:
        reach = [F.when(depth(clean) >= n, _at_depth(clean, n)) for n in levels]
    if len(reach) == 1:
        return inv.withColumn("t_anchor", reach[0]).where(F.col("t_anchor").isNotNull())
    return inv.withColumn("t_anchor", F.explode(F.array_compact(F.array(*reach))))


def _nested(inv: DataFrame, t: DataFrame, levels: list[int], prefixes: bool,
            limit: BroadcastLimit) -> tuple[DataFrame, DataFrame] | None:
    """Files at their deepest enclosing prefix or folder, and triggers at each such place that they reach.

    Both have ``container`` and ``t_anchor``, and joined on these give each file
    once per trigger, never a pair to drop.  None if the lookups do not fit.
    """
    forest = nest(t.select("container", F.col("t_anchor").alias("anchor")), levels, folders=not prefixes)
    if not fits(forest, limit):
        return None
    where = F.col("full_path") if prefixes else F.trim(F.col("directory"), F.lit("/"))
    files = locate(inv, forest, where, F.char_length(where) if prefixes else depth(where), "t_anchor")
    reach = forest.chains.select("container", F.col("node"), F.col("anchor").alias("t_anchor"))
    return (files.where(F.col("t_anchor").isNotNull()),
            join_checked(reach, t, ["container", "t_anchor"]).drop("t_anchor").withColumnRenamed("node", "t_anchor"))


@dataclass(frozen=True)
class SharedListings:
    """Different listings, and the triggers that asked for each.

    ``files``: inventory columns, the listings' own columns and ``listing``.
    ``askers``: ``trigger_id`` and ``listing`` for each valid trigger.  Many
    triggers with equal settings are listed once, and what is counted, written or
    kept per listing grows with the files, not with the triggers times the files.
    """

    files: DataFrame
    askers: DataFrame

    def per_trigger(self, *sums: str) -> DataFrame:
        """``n`` files of each trigger that has any, and sums of columns; files are counted once per listing."""
        return per_asker(self.files.groupBy("listing").agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in sums]),
                         self.askers, ["listing"])

    def expanded(self, limit: BroadcastLimit = DEFAULT_LIMIT) -> DataFrame:
        """Each file once per trigger."""
        return for_askers(self.files, self.askers, limit)


def per_asker(counts: DataFrame, askers: DataFrame, on: list[str]) -> DataFrame:
    """Numbers per listing as numbers per trigger, added up where a trigger asked more than once."""
    numbers = [c for c in counts.columns if c not in on]
    return counts.join(askers, on).groupBy("trigger_id").agg(*[F.sum(c).alias(c) for c in numbers])


def for_askers(rows: DataFrame, askers: DataFrame, limit: BroadcastLimit = DEFAULT_LIMIT,
               made: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Rows by ``listing`` once for each trigger that asked for it.

    The rows are dealt to all tasks first: each becomes as many as its listing
    has triggers, however few tasks read the inventory.  The more triggers a
    listing has, the more tasks there are, so that a task's rows grow with the
    files alone, and then a task gets the rows of as few listings as possible:
    the same triggers come again and again there, which takes little space where
    the result is written.  ``made`` derives rows (with ``listing``) from those that
    were dealt, so that they are not shuffled themselves.  An asker is a number and a hash, so many more of them than of
    whole triggers are a small table; it is broadcast as one array per listing,
    so a row is looked up once and its triggers lie beside each other, without
    the listing's hash in front of each.
    """
    n, size, listings = askers.agg(F.count(F.lit(1)), F.coalesce(F.sum(row_bytes(askers)), F.lit(0)),
                                   F.approx_count_distinct("listing")).first()
    fits = n <= 20 * limit.rows and size <= limit.bytes
    tasks = task_count(rows.sparkSession)
    more = math.ceil(n / max(listings, 1) / ASKERS_PER_TASK)
    tasks = max(tasks, min(tasks * more, MAX_TASKS))
    dealt = _dealt_by_listing(rows, askers, tasks, limit) if fits and more > 1 else rows.repartition(tasks)
    derived = dealt if made is None else made(dealt)
    if not fits:
        return join_checked(derived, askers, ["listing"], limit=limit, fits=fits)
    # Structs, because collect_list would leave a null out.
    lists = askers.groupBy("listing").agg(F.collect_list(F.struct(*[c for c in askers.columns if c != "listing"])).alias("_askers"))
    return (join_checked(derived, lists, ["listing"], limit=limit, fits=True)
            .select("listing", *[c for c in derived.columns if c != "listing"], F.inline("_askers")))


def _dealt_by_listing(rows: DataFrame, askers: DataFrame, tasks: int, limit: BroadcastLimit) -> DataFrame:
    """Rows that anybody asked for in as many tasks, each of which makes about as many rows for askers, listing by listing.

    Listings lie side by side on a line, each as wide as its rows times its
    askers, and a row lies in its listing at a place that its hash says; the line
    is cut into equal parts.  Which task a row goes to is the same when a task is
    repeated.
    """
    weights = rows.groupBy("listing").agg(F.count(F.lit(1)).alias("_rows")).join(
        askers.groupBy("listing").agg(F.count(F.lit(1)).alias("_n")), "listing").select(
        "listing", (F.col("_rows").cast("double") * F.col("_n")).alias("_width"))
    places = stage(weights.withColumn("_start", F.sum("_width").over(Window.orderBy("listing")) - F.col("_width")), "widths")
    total = places.agg(F.sum("_width")).first()[0] or 1.0
    hashable = [f.name for f in rows.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    within = F.pmod(F.xxhash64(*hashable), F.lit(1 << 30)) / F.lit(float(1 << 30))
    part = F.least(F.floor((F.col("_start") + within * F.col("_width")) / F.lit(total) * tasks), F.lit(tasks - 1)).cast("int")
    placed = join_checked(rows, places, ["listing"], limit=limit).withColumn("_part", part)
    return placed.repartitionById(tasks, "_part").select(*rows.columns)


def _asked(resolved: DataFrame, attrs: bool) -> DataFrame:
    """Valid triggers with the ``listing`` they ask for, staged."""
    valid = resolved.where(F.col("is_valid") & F.col("t_container").isNotNull())
    own = {"attrs": F.to_json("attrs", {"ignoreNullFields": "false"})} if attrs else {}
    listing = fingerprint({**{n: F.col(n) for n in SETTINGS}, **own})
    return stage(valid.select("trigger_id", *SETTINGS, "t_anchor", *(["attrs"] if attrs else []), listing.alias("listing")), "asked")


def _different(asked: DataFrame, attrs: bool) -> DataFrame:
    """One row per listing of ``_asked``."""
    columns = [*SETTINGS, "t_anchor", *(["attrs"] if attrs else [])]
    return stage(asked.groupBy("listing").agg(*[F.first(c).alias(c) for c in columns]), "listings")


def match_listings(resolved: DataFrame, inv: DataFrame, templates: ListingTemplates,
                   spec: FilterSpec | None = None, now_ms: int | None = None,
                   with_attrs: bool = False, limit: BroadcastLimit = DEFAULT_LIMIT) -> SharedListings:
    """``match_triggers`` with each different listing once; with ``with_attrs`` triggers must agree in their attributes too."""
    asked = _asked(resolved, with_attrs)
    files = _match(_different(asked, with_attrs), ["listing", *(["attrs"] if with_attrs else [])], inv, templates, spec, now_ms, limit)
    return SharedListings(files, asked.select("trigger_id", "listing"))


def match_triggers(resolved: DataFrame, inv: DataFrame, templates: ListingTemplates,
                   spec: FilterSpec | None = None, now_ms: int | None = None,
                   with_attrs: bool = False, limit: BroadcastLimit = DEFAULT_LIMIT) -> DataFrame:
    """Files of each valid trigger: inventory columns plus ``trigger_id``.

    If at least half of the triggers ask for what others ask for too, each
    different listing is made once, and its files are handed to its triggers.
    """
    own = ["trigger_id", *(["attrs"] if with_attrs else [])]
    asked = _asked(resolved, with_attrs)
    n, different = asked.agg(F.count(F.lit(1)), F.count_distinct("listing")).first()
    if 2 * different > n:
        return _match(asked, own, inv, templates, spec, now_ms, limit)
    files = _match(_different(asked, with_attrs), ["listing", *own[1:]], inv, templates, spec, now_ms, limit)
    return SharedListings(files, asked.select("trigger_id", "listing")).expanded(limit).select(*inv.columns, *own)


def _match(t: DataFrame, own: list[str], inv: DataFrame, templates: ListingTemplates,
           spec: FilterSpec | None, now_ms: int | None, limit: BroadcastLimit) -> DataFrame:
    """Files of each row of ``t`` (settings): inventory columns plus the row's ``own``.

    The settings that are the same for all triggers filter the inventory first.
    The rest is one equi-join on container and folder or prefix, with the trigger table
    broadcast if it was measured to fit, else shuffled with hot keys split; the
    patterns run on the pairs that are left.  A file is looked up at a few folder
    depths or prefix lengths by copies, at more by a search for its deepest one.
    Beyond ``CONSTANT_PATTERNS`` a name pattern runs only on names that contain
    its literal, which is part of the join key then, or, with more triggers than
    can be broadcast, on names that begin with the text that it begins with.
    """
    if spec is not None:
        if now_ms is None:
            raise ValueError("a filter needs now_ms")
        inv = apply_filters(inv, spec, now_ms)
    # Every container is at least the empty text; the comparison tells Spark that triggers may select folders of a
    # partitioned inventory, which it then finds out at run time (dynamic partition pruning).
    t = t.where(F.col("t_container") >= "").select(*SETTINGS, "t_anchor", *own)
    prefixes = templates.prefix is not None
    facts = _facts(t, limit, F.char_length if prefixes else depth)
    # Very many patterns of file names only meet names with a text that their matches must contain.
    prefilter = templates.file_filter is not None and facts.files is None and facts.fits
    if prefilter:
        t = stage(with_literal(t, "t_file", "t_literal"), "patterns")
        literals = literals_of(t, "t_literal")
    by_head = templates.file_filter is not None and facts.files is None and not facts.fits
    if by_head:
        heads = stage(with_head(t, "t_file", "t_head"), "patterns")
        lengths = head_lengths(heads, "t_head")
        t = headed(heads, "t_head", lengths)
    extra = [c for c, there in (("t_literal", prefilter), ("t_head", by_head)) if there]
    t = t.select(
        *extra, *[c for c in own if c != "attrs"], F.col("t_container").alias("container"), "t_anchor", "t_prefix", "t_directory",
        _coded(F.col("t_file"), facts.files).alias("t_file"),
        _coded(F.col("t_path"), facts.paths).alias("t_path"),
        *[c for c in own if c == "attrs"])
    tests, fitting = [], facts.fits
    if templates.prefix is not None:
        tests.append(F.startswith(F.col("full_path"), F.col("t_prefix")))
        if not templates.recursive:
            rest = F.substring(F.col("full_path"), F.length("t_prefix") + 1, F.length("full_path"))
            tests.append(~rest.contains("/"))
    if templates.file_filter is not None:
        tests.append(_matches(F.col("filename"), F.col("t_file"), facts.files))
    if templates.path_filter is not None:
        where = F.col("directory")
        if templates.relative_paths and templates.directory is not None:
            where = relative_dir(where, F.col("t_directory"))
        tests.append(_matches(where, F.col("t_path"), facts.paths))
    if templates.directory is not None and not templates.recursive:
        side = inv.withColumn("t_anchor", F.trim(F.col("directory"), F.lit("/")))
    else:
        nested = _nested(inv, t, facts.depths, prefixes, limit) if facts.fits and len(facts.depths) > COPIED_LEVELS else None
        side, t = nested or (_anchored(inv, facts.depths or [0], prefixes), t)
        fitting = fitting if nested is None else None  # what triggers reach may be more than there are triggers
    on = ["container"] if facts.depths in ([], [0]) and not (
        templates.directory is not None and not templates.recursive) else ["container", "t_anchor"]
    if prefilter:
        side, on = contained(side, "filename", literals, "t_literal"), [*on, "t_literal"]
    if by_head:
        side, on = headed(side, "filename", lengths, "t_head"), [*on, "t_head"]
    if "t_anchor" not in on:
        side, t = side.drop("t_anchor"), t.drop("t_anchor")
    if fitting is False:
        # Too many triggers to broadcast; the places they look at may still fit.
        places = t.select(*on).distinct()
        if measure(places, limit):
            side = side.join(F.broadcast(places), on, "left_semi")
        else:
            hashes = stage(places.select(F.xxhash64(*on).alias("_place")).distinct(), "places")
            if measure(hashes, PLACES):
                side = side.withColumn("_place", F.xxhash64(*on)).join(F.broadcast(hashes), "_place", "left_semi").drop("_place")
    out = join_checked(side, t, on, "inner", limit=limit, fits=fitting)
    for test in tests:
        out = out.where(test)
    return out.select(*inv.columns, *own)


def list_for_triggers(triggers: DataFrame, inv: DataFrame, templates: ListingTemplates,
                      spec: FilterSpec | None = None, now_ms: int | None = None,
                      with_attrs: bool = False, limit: BroadcastLimit = DEFAULT_LIMIT) -> DataFrame:
    """Every trigger lists its own container and folder with its own filters."""
    return match_triggers(resolve_triggers(triggers, templates), inv, templates, spec, now_ms, with_attrs, limit)


def matched_ids(matches: DataFrame) -> DataFrame:
    """Triggers with at least one file.  Duplicates fall away before the shuffle."""
    return matches.select("trigger_id").distinct()


def unmatched_triggers(triggers: DataFrame, matches: DataFrame) -> DataFrame:
    """Triggers without any matching file."""
    return triggers.join(matched_ids(matches), "trigger_id", "left_anti")


def has_objects(inv: DataFrame, triggers: DataFrame, templates: ListingTemplates,
                limit: BroadcastLimit = DEFAULT_LIMIT) -> DataFrame:
    """Add ``has_objects``: does the trigger's container and prefix hold anything at all?

    Runs before any filter.  A null or empty prefix means the whole container,
    a blank one is a prefix like any other.
    """
    bare = ListingTemplates(templates.container, templates.directory, templates.prefix)
    found = matched_ids(match_triggers(resolve_triggers(triggers, bare), inv, bare, limit=limit))
    flagged = found.withColumn("has_objects", F.lit(True))
    return (triggers.join(flagged, "trigger_id", "left")
            .withColumn("has_objects", F.coalesce("has_objects", F.lit(False))))


def trigger_counts(triggers: DataFrame, matches: DataFrame) -> DataFrame:
    """Per trigger: ``record_count`` and ``bytes`` (null when nothing matched)."""
    counts = matches.groupBy("trigger_id").agg(F.count(F.lit(1)).alias("record_count"),
                                               F.sum("size").alias("bytes"))
    return (triggers.join(counts, "trigger_id", "left")
            .withColumn("record_count", F.coalesce("record_count", F.lit(0))))


def outcome(record_count: Column, failed: Column | None = None) -> Column:
    """Route of a trigger as a whole, from its number of matching files."""
    route = F.when(record_count > 0, F.lit(SUCCESS)).otherwise(F.lit(NO_FILES))
    return route if failed is None else F.when(failed, F.lit(FAILURE)).otherwise(route)


def route_union(*routes: DataFrame) -> DataFrame:
    """Rows of all routes of one run in one table."""
    out = routes[0]
    for r in routes[1:]:
        out = out.unionByName(r, allowMissingColumns=True)
    return out


def empty_attributes(target: Column, mime_type: str) -> Column:
    """Attributes of a trigger without files: its own, its target, and a record count of zero."""
    none = F.create_map(F.lit("record.count"), F.lit("0"), F.lit("mime.type"), F.lit(mime_type))
    return merge_attributes(F.col("attrs"), merge_attributes(target, none))


def _failed_rows(triggers: DataFrame, failed: DataFrame, target: Column) -> DataFrame:
    described = join_checked(triggers, failed, ["trigger_id"])
    kind = F.col("error_class") if "error_class" in failed.columns else F.lit(None).cast("string")
    message = F.col("error_message") if "error_message" in failed.columns else F.lit(None).cast("string")
    attrs = merge_attributes(F.col("attrs"), merge_attributes(target, F.map_filter(
        error_attributes(message, kind), lambda k, v: v.isNotNull())))
    return described.select(*failed.columns, attrs.alias("attributes"))


def route_listing(triggers: DataFrame, matches: DataFrame, emitted: DataFrame | None = None,
                  failed: DataFrame | None = None, records_requested: bool = True,
                  target: Column | None = None, mime_type: str = "application/parquet") -> DataFrame:
    """Rows of a run with their ``route``.

    ``matches`` are the files that pass the filters regardless of the stored
    time, ``emitted`` those of them that are new (default: all).  A trigger
    whose matches are all old gives no row at all; one without any match gives a
    ``no_files`` row if records are requested; those in ``failed``
    (``trigger_id``, ``error_message``, ``error_class`` and whatever else
    describes the error) give a ``failure`` row and nothing else.  With
    ``target``, a map over the trigger's columns, the last two kinds of rows
    have ``attributes``: the trigger's own (``attrs``), the target's, and the
    record count or the error.  Both tables of files are used twice: stage them
    if they are costly.
    """
    rows = (matches if emitted is None else emitted).withColumn("route", F.lit(SUCCESS))
    parts = []
    live = triggers
    if failed is not None:
        ids = failed.select("trigger_id").distinct()
        live = triggers.join(ids, "trigger_id", "left_anti")
        rows = join_checked(rows, ids, ["trigger_id"], "left_anti")
        parts.append((failed if target is None else _failed_rows(triggers, failed, target)).withColumn("route", F.lit(FAILURE)))
    if records_requested:
        files = matches.where(~F.col("is_directory")) if "is_directory" in matches.columns else matches
        parts.append(_empty_rows(unmatched_triggers(live, files), target, mime_type))
    return route_union(rows, *parts)


def _empty_rows(triggers: DataFrame, target: Column | None, mime_type: str) -> DataFrame:
    described = [] if target is None else [empty_attributes(target, mime_type).alias("attributes")]
    return triggers.select("trigger_id", *described).withColumn("route", F.lit(NO_FILES))


def route_listing_s3(triggers: DataFrame, inv: DataFrame, matches: DataFrame, templates: ListingTemplates,
                     records_requested: bool = True, target: Column | None = None,
                     mime_type: str = "application/parquet") -> DataFrame:
    """Object-store routing: emptiness is tested on the prefix before any filter.

    A trigger whose objects are all filtered away gives no row.  ``target`` as
    in ``route_listing``.
    """
    parts = [matches.withColumn("route", F.lit(SUCCESS))]
    if records_requested:
        empty = has_objects(inv, triggers, templates).where(~F.col("has_objects"))
        parts.append(_empty_rows(empty, target, mime_type))
    return route_union(*parts)


def error_rows(triggers: DataFrame, causes: Column, target: Column, deepest: bool = False) -> DataFrame:
    """Failure rows: trigger attributes overlaid by the target and the error.

    ``causes`` is the chain of errors as an array of ``(class, message)``.
    """
    cause = root_cause(causes, deepest)
    attrs = merge_attributes(F.col("attrs"), merge_attributes(
        target, error_attributes(cause["message"], cause["class"])))
    return triggers.withColumn("route", F.lit(FAILURE)).withColumn("attributes", attrs)


def emit_attributes(matches: DataFrame, listing: Column) -> DataFrame:
    """Attributes of each listed row: those of its trigger, overlaid by the listing's own."""
    return matches.withColumn("attributes", merge_attributes(F.col("attrs"), listing))
