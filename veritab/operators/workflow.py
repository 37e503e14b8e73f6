"""Queues, selections, counters of the review work, and the state changes that it makes.

State changes are rows to append: every function returns frames, and a single writer appends them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veritab.functions import numbers, states, text, urls
from veritab.operators.resolve import held_names

# How far discovery methods are trusted, the best first.
METHOD_ORDER = ("domain_override", "operator_manual", "seed_csv", "region_index", "official_site", "owner_pattern", "web_search")


# --- selections and limits


def pending(items: DataFrame, limit: int | None = None) -> DataFrame:
    """SORT-01, SORT-06, SORT-07: open items by priority, then confidence, unknown last."""
    out = items.filter("status = 'pending'").orderBy(F.col("priority").asc(), F.col("confidence").desc_nulls_last(), "item_id")
    return out if limit is None else out.limit(limit)


def recent(rows: DataFrame, limit: int, **where: str) -> DataFrame:
    """SORT-03, JOIN-23: the newest rows that match."""
    for column, value in where.items():
        rows = rows.filter(F.col(column) == value)
    return rows.orderBy(F.col("at").desc(), F.col("id").desc()).limit(limit)


def documents_in(document: DataFrame, statuses: Sequence[str], period: int | None = None, unknown: bool = True, limit: int = 500) -> DataFrame:
    """SORT-04, SORT-05: documents in given states, of a period or, with unknown, of none."""
    out = document.filter(F.col("status").isin(*statuses))
    if period is not None:
        out = out.filter((F.col("period") == period) | (F.lit(unknown) & F.col("period").isNull()))
    return out.orderBy("status", F.col("document_id").desc()).limit(limit)


def found_by_name(entity: DataFrame, words: str, limit: int = 20) -> DataFrame:
    """SORT-08: active entities whose name holds the words."""
    return entity.filter(F.col("active") & F.col("name").contains(words)).orderBy("name", "entity_id").limit(limit)


def missing_target(entity: DataFrame, site: DataFrame, document: DataFrame, period: int, methods: Sequence[str]) -> DataFrame:
    """SORT-10, JOIN-21: active entities with a usable site and no target document of the period, by id."""
    done = document.filter((F.col("doc_class") == "target") & (F.col("status") == "ingested") & (F.col("period") == period)).select("entity_id")
    usable = site.filter(F.col("method").isin(*methods)).select("entity_id")
    return entity.filter("active").join(usable, "entity_id", "left_semi").join(done, "entity_id", "left_anti").select("entity_id").orderBy("entity_id")


def stale(entity: DataFrame, site: DataFrame, document: DataFrame, period: int, methods: Sequence[str]) -> DataFrame:
    """SORT-09: of those, the ones with an older target document, the oldest first."""
    older = document.filter((F.col("doc_class") == "target") & (F.col("status") == "ingested") & (F.col("period") < period)).groupBy("entity_id").agg(F.max("period").alias("latest"))
    return missing_target(entity, site, document, period, methods).join(older, "entity_id").orderBy("latest", "entity_id")


def crawl_order(site: DataFrame, excluded: DataFrame, done: DataFrame, limit: int) -> DataFrame:
    """SORT-13, JOIN-21: sites to crawl: not of excluded or finished entities, and no guessed site where an override
    stands; the most trusted method first, disclosure pages before homepages."""
    override = site.filter("method = 'domain_override'").select("entity_id").distinct()
    guessed = site.filter("method = 'owner_pattern'").join(override, "entity_id", "left_semi").select("site_id")
    rank = F.lit(len(METHOD_ORDER))
    for i, m in reversed(list(enumerate(METHOD_ORDER))):
        rank = F.when(F.col("method") == m, i).otherwise(rank)
    out = site.join(excluded.select("entity_id"), "entity_id", "left_anti").join(done.select("entity_id"), "entity_id", "left_anti").join(guessed, "site_id", "left_anti")
    return out.orderBy(rank, "entity_id", (urls.quality(F.col("url")) != "disclosure").cast("int"), "site_id").limit(limit)


def of_bucket(rows: DataFrame, buckets: DataFrame, bucket: str) -> DataFrame:
    """FLT-12: task rows whose entity is in a bucket."""
    return rows.join(buckets.filter(F.col("bucket") == bucket).select("entity_id"), "entity_id", "left_semi")


def of_action(rows: DataFrame, action: str) -> DataFrame:
    """FLT-13: queue rows by what is to be done next."""
    return rows.filter(states.next_action(F.col("blocking_reason"), F.lit(False)) == action)


def site_scope(site: DataFrame, entity: DataFrame, region: str | None = None, method: str | None = None) -> DataFrame:
    """JOIN-20, AGG-44: sites with their entity's region and type, narrowed."""
    out = site.join(entity.select("entity_id", "region", "entity_type"), "entity_id")
    if region is not None:
        out = out.filter(F.col("region") == region)
    return out if method is None else out.filter(F.col("method") == method)


# --- identity of documents and links


def identity_matches(parsed: Column, names: Column) -> Column:
    """JOIN-25: whether a parsed name is one of an entity's names: exactly, without spaces, as a variant, or held by or
    holding one when both have six characters.  The names are normalised already, by text.name_variant."""
    return F.exists(names, lambda n: (n == parsed) | ((F.length(n) >= 6) & (F.length(parsed) >= 6) & (n.contains(parsed) | parsed.contains(n))))


def same_or_campus(label: Column, entity: Column) -> Column:
    """JOIN-29: the entity's label, or it with a place added; both of four characters at least."""
    rest = F.substring(label, F.length(entity) + 1, F.length(label))
    return (F.length(label) >= 4) & (F.length(entity) >= 4) & ((label == entity) | (label.startswith(entity) & rest.rlike("^.{0,8}(校|キャンパス|校舎)$")))


def names_another(label: Column, entity: Column, others: Column) -> Column:
    """JOIN-30: whether a candidate's label names another entity and not this one."""
    return ~same_or_campus(label, entity) & F.exists(others, lambda o: (F.length(o) >= 4) & label.contains(o) & (o != entity))


def owner_pages(entity: DataFrame, pages: DataFrame) -> DataFrame:
    """JOIN-28: for each (entity_id, owner, token), the owner's page whose address holds the token: documents first,
    then pages that hint at disclosure, then the shortest; the first hit wins."""
    tokens = entity.select("entity_id", "owner", F.col("token").alias("k"))
    addresses = pages.select("url", "owner", F.lower("url").alias("rk"))
    held = held_names(tokens.filter(F.length("k") > 1), addresses, "owner")
    # a token of one letter has no pair to be found by
    letter = tokens.filter(F.length("k") == 1).select("owner", "k").distinct().join(addresses.select("owner", "rk").distinct(), "owner").filter(F.col("rk").contains(F.col("k")))
    q = urls.quality(F.col("url"))
    rank = F.struct(F.when(q == "direct_pdf", 0).when(q == "disclosure", 1).otherwise(2).alias("turn"), F.length("url").alias("length"), "url")
    # what an owner's token leads to is the same for all who have it, and addresses that differ by case only are one text
    listed = addresses.filter("rk IS NOT NULL").groupBy("owner", "rk").agg(F.min(rank).alias("b"))
    first = held.unionByName(letter.select(*held.columns)).join(listed.hint("merge"), ["owner", "rk"]).groupBy("owner", "k").agg(F.min("b").alias("b"))
    found = tokens.join(first.hint("merge"), ["owner", "k"]).groupBy("entity_id").agg(F.min("b").alias("b"))
    return found.select("entity_id", "b.url")


# --- counters


def year_overview(entity: DataFrame, document: DataFrame, period: int) -> DataFrame:
    """AGG-23: one row: entities with a target document of the period, with older ones only, with later ones."""
    t = document.filter((F.col("doc_class") == "target") & (F.col("status") == "ingested")).join(entity.filter("active").select("entity_id"), "entity_id", "left_semi")
    per = t.groupBy("entity_id").agg(F.bool_or(F.col("period") == period).alias("now"), F.bool_or(F.col("period") < period).alias("old"), F.bool_or(F.col("period") > period).alias("later"))
    return per.agg(F.count_if("now").alias("current"), F.count_if(F.col("old") & ~F.col("now")).alias("stale"), F.count_if("later").alias("future"))


def url_stats(entity: DataFrame, site: DataFrame) -> DataFrame:
    """AGG-24: one row: active entities, those with a site, with a verified one, and sites by trust."""
    a = entity.filter("active").select("entity_id")
    j = a.join(site, "entity_id", "left")
    trusted = states.trust_tier(F.col("method")) < "t4"
    return j.agg(F.count_distinct("entity_id").alias("entities"), F.count_distinct(F.when(F.col("site_id").isNotNull(), F.col("entity_id"))).alias("with_url"), F.count_distinct(F.when(F.col("verified"), F.col("entity_id"))).alias("verified"), F.count_if(trusted & F.col("site_id").isNotNull()).alias("trusted_sites"))


def review_stats(items: DataFrame) -> DataFrame:
    """AGG-28, AGG-27: one row: items by status and by urgency."""
    s = F.col("status")
    return items.agg(F.count("*").alias("total"), F.count_if(s == "pending").alias("pending"), F.count_if(s.isin("approved", "corrected")).alias("resolved"), F.count_if((s == "pending") & (F.col("priority") <= 1)).alias("urgent"))


def todo_counts(items: DataFrame, aliases: DataFrame, now: Column, days: int = 30) -> DataFrame:
    """AGG-26: one row: open items, and whether the newest alias is older than so many days."""
    last = aliases.agg(F.max("created_at").alias("last_alias"))
    return items.agg(F.count_if(F.col("status") == "pending").alias("pending")).join(last, F.lit(True), "left").withColumn("aliases_stale", F.coalesce(F.datediff(now, "last_alias") > days, F.lit(True)))


def manual_summary(rows: DataFrame) -> DataFrame:
    """AGG-30: rows of the manual queue by next action."""
    return rows.groupBy(states.next_action(F.col("blocking_reason"), F.lit(False)).alias("action")).agg(F.count("*").alias("n"))


def worst_verdict(fact: DataFrame) -> DataFrame:
    """AGG-31: by document: rows, mean confidence, and the worst verdict."""
    v = numbers.verdict(F.col("confidence"))
    rank = F.when(v == "auto", 0).when(v == "auto_flag", 1).when(v == "review_pending", 2).otherwise(3)
    return fact.filter("confidence IS NOT NULL").groupBy("document_id").agg(F.count("*").alias("rows"), F.round(F.avg("confidence"), 6).alias("mean_confidence"), F.max_by(v, rank).alias("worst"))


def strict_yield(status: DataFrame) -> DataFrame:
    """AGG-32, AGG-35: the eight bucket counts of the yield analysis that rest on status rows, in one pass by grouping
    sets, with each bucket's share."""
    dims = ["url_status", "document_status", "extract_status", "blocking_reason"]
    s = status.select(*[F.coalesce(F.col(d), F.lit("-")).alias(d) for d in dims])
    out = s.groupingSets([[d] for d in dims], *dims).agg(F.count("*").alias("n"), F.grouping_id().alias("g"))
    total = status.agg(F.count("*").alias("total"))
    named = out.select(F.element_at(F.array(*map(F.lit, dims)), F.locate("0", F.lpad(F.bin("g"), len(dims), "0"))).alias("dimension"), F.coalesce(*dims).alias("value"), "n")
    return F.broadcast(total).join(named, F.lit(True)).select("dimension", "value", "n", (F.col("n") / F.col("total")).alias("share"))


def yield_groupings(rows: DataFrame, groupings: dict[str, Sequence[str]]) -> DataFrame:
    """AGG-32: the yield analysis's counts: entities by each grouping of columns, all in one pass by grouping sets, as
    (grouping, value, n, share), the values of several columns joined by bars and null shown as a dash.

    The analysis groups by status, by site and document, by document state, by host, by source of the site, by owner,
    by whether there are yearly rows, and by whether any is of low confidence.
    """
    columns = list(dict.fromkeys(c for g in groupings.values() for c in g))
    shown = rows.select(*[F.coalesce(F.col(c).cast("string"), F.lit("-")).alias(c) for c in columns])
    sets = [list(g) for g in groupings.values()]
    counted = shown.groupingSets(sets, *columns).agg(F.count("*").alias("n"), F.grouping_id().alias("g"))
    bits = {name: sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in g) for name, g in groupings.items()}
    parts = [F.when(F.col("g") == bits[name], F.struct(F.lit(name).alias("grouping"), F.concat_ws("|", *g).alias("value"))) for name, g in groupings.items()]
    total = rows.agg(F.count("*").alias("total"))
    named = counted.select(F.coalesce(*parts).alias("p"), "n").select("p.grouping", "p.value", "n")
    return named.join(F.broadcast(total), F.lit(True)).select("grouping", "value", "n", F.round(F.col("n") / F.col("total"), 6).alias("share"))


def weekly_yield(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """AGG-35: by week (from Monday) and group of (entity_id, at, confirmed, parsed): the entities selected, those with a
    confirmed document, those with parsed rows, and both shares in percent."""
    flags = rows.groupBy(*by, F.date_trunc("week", "at").cast("date").alias("week"), "entity_id").agg(F.bool_or("confirmed").alias("confirmed"), F.bool_or("parsed").alias("parsed"))
    out = flags.groupBy(*by, "week").agg(F.count("*").alias("selected"), F.count_if("confirmed").alias("confirmed"), F.count_if("parsed").alias("parsed"))
    share = lambda n: F.round(F.col(n) * 100.0 / F.col("selected"), 4)
    return out.select(*by, "week", "selected", "confirmed", "parsed", share("parsed").alias("strict_yield"), share("confirmed").alias("broad_yield"))


def region_report(matches: DataFrame, rows: DataFrame) -> DataFrame:
    """AGG-21: by region: rows of its index, those matched, and the matches by strategy."""
    j = rows.join(matches, "row_id", "left")
    return j.groupBy("region").agg(F.count("*").alias("rows"), F.count("entity_id").alias("matched"), F.count_if(F.col("tier") == "exact").alias("exact"), F.count_if(F.col("tier").isNotNull() & (F.col("tier") != "exact")).alias("loose"))


def log_signals(log: DataFrame, now: Column, after_s: int = 3600) -> DataFrame:
    """CLS-22: what an operational log shows: errors, timeouts, and runs that have gone quiet."""
    m = F.lower(F.coalesce("message", F.lit("")))
    flagged = log.withColumns({"error": m.contains("error"), "timeout": m.contains("timeout") | m.contains("timed out")})
    out = flagged.groupBy("run_id").agg(F.count_if("error").alias("errors"), F.count_if("timeout").alias("timeouts"), F.max("at").alias("last_at"))
    return out.withColumn("quiet", F.unix_timestamp(now) - F.unix_timestamp("last_at") > after_s)


# --- sets that keep their order


def distinct_in_order(c: Column) -> Column:
    """SET-06."""
    return F.array_distinct(c)


def with_new(existing: DataFrame, more: DataFrame, key: Sequence[str]) -> DataFrame:
    """SET-07, SET-08: existing rows, then those of more whose key is new, the first of each."""
    fresh = more.join(existing.select(*key).distinct(), list(key), "left_anti").dropDuplicates(list(key))
    return existing.unionByName(fresh.select(*existing.columns))


def orphans(files: DataFrame, document: DataFrame, keep_from: int) -> DataFrame:
    """SET-09: stored files that no document of a kept period names."""
    return files.join(document.filter(F.col("period") >= keep_from).select("path"), "path", "left_anti")


# --- state changes


def audit(rows: DataFrame, action: str, table: str, target: Column, old: Column, new: Column, reason: str, actor: str, at: Column) -> DataFrame:
    """UPD-17: audit rows with ids made of what they say, so that writing them again can be told."""
    shown = [F.lit(action).alias("action"), F.lit(table).alias("target_table"), target.cast("string").alias("target_id"), old.cast("string").alias("old_value"), new.cast("string").alias("new_value"), F.lit(reason).alias("reason"), F.lit(actor).alias("actor"), at.alias("at")]
    out = rows.select(*shown)
    key = F.sha2(F.to_json(F.array("action", "target_table", "target_id", "old_value", "new_value", F.col("at").cast("string"))), 256)
    return out.withColumn("action_id", key)


def manual_entries(entries: DataFrame, existing: DataFrame) -> DataFrame:
    """UPD-05: an operator's valid entries as fact revisions of full extraction confidence."""
    from veritab.operators.revision import appended

    wrong = states.errors((F.col("capacity") < 0, "capacity"), (F.col("enrollment") < 0, "enrollment"), (~F.col("dropout_rate").between(0, 1), "dropout_rate"))
    good = entries.filter(F.size(wrong) == 0).withColumn("confidence", numbers.composite(F.lit(1.0), numbers.completeness([F.col("capacity"), F.col("enrollment")]), F.lit(numbers.NEUTRAL)))
    return appended(existing, good, ["unit_id", "period"], ["entry_id"])


def manual_entry_audit(entries: DataFrame, appended: DataFrame, actor: str, at: Column) -> DataFrame:
    """UPD-05: audit rows of the manual entries that were appended: what each unit's enrolment became."""
    written = entries.join(appended.select("entry_id"), "entry_id", "left_semi")
    return audit(written, "manual_entry", "fact", F.concat_ws("/", F.col("unit_id").cast("string"), F.col("period").cast("string")), F.lit(None), F.col("enrollment"), "entered by hand", actor, at)


def applied_codes(entity: DataFrame, matches: DataFrame) -> DataFrame:
    """UPD-07: entities with the code that a reconciliation gives them; one that has a code keeps it."""
    return entity.join(matches.select("entity_id", F.col("code").alias("_new")), "entity_id", "left").withColumn("code", F.coalesce("code", "_new")).drop("_new")


def comparison_run(compared: DataFrame, content: bytes, system: str) -> tuple[DataFrame, DataFrame]:
    """UPD-08, JSN-03: the header and the result rows of a comparison, named by their content."""
    from veritab.functions.payloads import row_key

    digest = F.sha2(F.lit(content), 256)
    rows = compared.withColumns({"run_id": digest, "row_key": row_key(F.col("key"), F.col("review_id"), F.col("source_row"), F.col("status"))})
    header = rows.groupBy("run_id").agg(F.count("*").alias("rows"), F.count_if(F.col("status") == "match").alias("matches")).withColumn("system", F.lit(system))
    return header, rows


def decided(decisions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """UPD-11: decisions that may be written, and those that may not with what is wrong with them."""
    wrong = states.errors(
        (~F.col("decision").isin("accepted", "corrected", "excluded"), "unknown decision"),
        ((F.col("decision") == "corrected") & F.col("value").isNull(), "a correction needs a value"),
        ((F.col("decision") != "corrected") & F.col("value").isNotNull(), "only a correction has a value"),
    )
    d = decisions.withColumn("errors", wrong)
    return d.filter(F.size("errors") == 0).drop("errors"), d.filter(F.size("errors") > 0)


def new_review_items(candidates: DataFrame, items: DataFrame) -> DataFrame:
    """UPD-13: review items for what has none yet, with priorities by kind."""
    priority = F.when(F.col("kind") == "code_conflict", 0).when(F.col("kind") == "unmatched", 1).otherwise(2)
    return candidates.join(items.select("kind", "target_id"), ["kind", "target_id"], "left_anti").withColumns({"priority": priority, "status": F.lit("pending")})


def writer_plan(site: DataFrame, found: DataFrame) -> DataFrame:
    """UPD-14, URL-05: for each entity's found address: add, upgrade (with the site that it replaces, the lowest in
    quality, then id) or noop."""
    q = urls.quality(F.col("url"))
    rank = F.element_at(F.create_map(*[F.lit(x) for p in urls.QUALITY_RANK.items() for x in p]), q)
    have = site.groupBy("entity_id").agg(F.collect_set(q).alias("qualities"), F.min_by("site_id", F.struct(rank.alias("r"), F.col("site_id").alias("i"))).alias("worst_site"))
    j = found.join(have, "entity_id", "left").withColumn("qualities", F.coalesce("qualities", F.array().cast("array<string>")))
    out = j.withColumn("action", urls.writer_action(urls.quality(F.col("url")), F.col("qualities")))
    return out.select("entity_id", "url", "action", F.when(F.col("action") == "upgrade", F.col("worst_site")).alias("replaces"))


def inferred_sites(entity: DataFrame, site: DataFrame, domains: DataFrame) -> DataFrame:
    """UPD-15: owners' domains as sites of their entities that have none."""
    return entity.filter("active").join(site.select("entity_id"), "entity_id", "left_anti").join(domains, "owner").select("entity_id", F.col("domain").alias("url"), F.lit("owner_pattern").alias("method"))


def routed(scored: DataFrame) -> dict[str, DataFrame]:
    """UPD-16: scored addresses by decision: sites to write, items to review, and a log of the rest."""
    confidence = numbers.score_to_confidence(F.col("score"))
    out = scored.withColumn("confidence", confidence)
    return {d: out.filter(F.col("decision") == d) for d in ("auto", "review", "reject")}


def approved_aliases(proposals: DataFrame, aliases: DataFrame, entity: DataFrame) -> tuple[DataFrame, DataFrame]:
    """UPD-18: aliases to append, and proposals refused as the alias is another entity's name or alias already."""
    taken = entity.select("entity_id", text.squeezed(F.col("name")).alias("k")).unionByName(aliases.select("entity_id", text.squeezed(F.col("alias")).alias("k"))).distinct()
    p = proposals.withColumn("k", text.squeezed(F.col("alias")))
    other = p.alias("p").join(taken.alias("t"), (F.col("p.k") == F.col("t.k")) & (F.col("p.entity_id") != F.col("t.entity_id")), "left_semi").select("entity_id", "alias")
    return proposals.join(other, ["entity_id", "alias"], "left_anti"), other
