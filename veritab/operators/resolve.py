"""Entity resolution: tiers of ever looser keys, the first tier that finds something wins, ambiguity is refused.

All tiers meet in one join on (tier, key), of which each row keeps its first; only containment, which costs more, sees
just what the keys left over.  Containment tests are equi joins on a run of letters of the shorter name within a block
(the region): what holds a name holds that run too.  They compare different texts; copies are counted before and found
again behind.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veritab.functions.text import containment, institution_key, kana_folded, squeezed
from veritab.streaming.state import stored

Key = Callable[[Column], Column]


#: Texts of so many letters are looked up whole; longer ones by the rarest run of as many letters.
GRAM = 8
#: Kinds of runs, by their ends and length, that are told apart before anything is shuffled.
SHAPES = 65_536
#: Parts that texts are dealt to before they are cut up: there is many times more of their runs than of them.
PARTS = 200


def _shape(gram: Column) -> Column:
    n = F.length(gram)
    return F.pmod(F.xxhash64(F.substring(gram, F.lit(1), F.lit(2)), F.substring(gram, n - 1, F.lit(2)), n), F.lit(SHAPES))


def _runs(texts: DataFrame, block: str, c: str) -> DataFrame:
    """block, c and gram: the runs of two to GRAM letters of each text, once for each place; a single letter is its own."""
    n = F.length(c)
    placed = texts.filter(F.col(c) != "").select(block, c, F.explode(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1)))).alias("at"))
    sized = placed.select("*", F.explode(F.sequence(F.least(n, F.lit(2)), F.least(n - F.col("at") + 1, F.lit(GRAM)))).alias("size"))
    return sized.select(block, c, F.substring(F.col(c), F.col("at"), F.col("size")).alias("gram"))


def held_names(inner: DataFrame, outer: DataFrame, block: str) -> DataFrame:
    """(block, k, rk): the different texts k of (block, k) and rk of (block, rk) in a block of which rk holds k, each pair once.

    A k of GRAM letters or less meets the runs that equal it, a longer one those that equal its rarest run, so that what is
    compared grows with what is found and not with a block.  Runs whose ends and length no k has are dropped unshuffled.
    Empty and null texts meet none, a text of one letter only itself.  Joins are merges: sizes of exploded rows are
    estimated by those of files, so Spark would broadcast tables of any size.
    """
    i = inner.select(block, "k").filter("k <> ''").distinct()
    whole = i.filter(F.length("k") <= GRAM).select(block, "k", F.col("k").alias("gram"))
    parts = i.filter(F.length("k") > GRAM).select(block, "k", F.explode(F.sequence(F.lit(1), F.greatest(F.length("k") - (GRAM - 1), F.lit(1)))).alias("at"))
    parts = parts.select(block, "k", F.substring(F.col("k"), F.col("at"), F.lit(GRAM)).alias("gram"))
    shapes = whole.select(_shape(F.col("gram")).alias("shape")).unionByName(parts.select(_shape(F.col("gram")).alias("shape"))).distinct()
    runs = _runs(outer.select(block, "rk").repartition(PARTS, block, "rk").distinct(), block, "rk").withColumn("shape", _shape(F.col("gram"))).join(F.broadcast(shapes), "shape", "left_semi").drop("shape")
    often = runs.filter(F.length("gram") == GRAM).groupBy(block, "gram").agg(F.count("*").alias("n"))
    # a run that only inner texts have leads nowhere, so it counts as rarest and ends the search at once
    rare = parts.join(often.hint("merge"), [block, "gram"], "left").groupBy(block, "k").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram"))["gram"].alias("gram"))
    return whole.unionByName(rare).join(runs.hint("merge"), [block, "gram"]).filter(F.col("rk").contains(F.col("k"))).select(block, "k", "rk").distinct()


def held_texts(inner: DataFrame, outer: DataFrame, block: str) -> DataFrame:
    """(inner_id, outer_id, block, k, rk): pairs of a block of (inner_id, block, k) and (outer_id, block, rk) whose rk holds k.

    All copies of a text are paired, so this is for blocks that hold few; callers that want the best or only one of the
    pairs take held_names.
    """
    names = held_names(inner, outer, block)
    pairs = names.join(inner.select("inner_id", block, "k").hint("merge"), [block, "k"]).join(outer.select("outer_id", block, "rk").hint("merge"), [block, "rk"])
    return pairs.select("inner_id", "outer_id", block, "k", "rk")


def containing(left: DataFrame, right: DataFrame, block: str) -> DataFrame:
    """(block, k, rk): the different texts k of (block, k) and rk of (block, rk) in a block of which one holds the other."""
    held = held_names(left, right, block)
    holds = held_names(right.select(block, F.col("rk").alias("k")), left.select(block, F.col("k").alias("rk")), block)
    return held.unionByName(holds.select(block, F.col("rk").alias("k"), F.col("k").alias("rk"))).distinct()


def tiered(left: DataFrame, right: DataFrame, tiers: Sequence[tuple[str, Key, bool]], least: float | None = None) -> DataFrame:
    """JOIN-05, JOIN-09: (left_id, right_id, tier): each left row's match in the first tier that has one.

    left: left_id, name, region; right: right_id, name, region.  A tier is its name, the key that names are joined by,
    and whether regions must agree.  Within a tier the same region comes first, then the lowest right_id.  With least,
    a last tier takes the best containment score of at least that in the same region.  Null names match nothing.
    """
    keys = [key for _, key, _ in tiers]
    l, r = _by_tier(left, "left_id", keys), _by_tier(right, "right_id", keys)
    first = r.groupBy("turn", "k", F.col("region").alias("r_region")).agg(F.min("right_id").alias("right_id"))
    regional = F.array(*[F.lit(only) for _, _, only in tiers])[F.col("turn")]
    pairs = l.join(first, ["turn", "k"]).withColumn("other", (~F.coalesce(F.col("region") == F.col("r_region"), F.lit(False))).cast("int"))
    best = pairs.filter(~regional | (F.col("other") == 0)).groupBy("left_id").agg(F.min(F.struct("turn", "other", "right_id")).alias("b"))
    named = F.array(*[F.lit(name) for name, _, _ in tiers])
    found = best.select("left_id", "b.right_id", named[F.col("b.turn")].alias("tier"))
    if least is None:
        return found
    found, last = stored(found, "found"), len(tiers) - 1
    rest = stored(l.filter(F.col("turn") == last).join(found.select("left_id"), "left_id", "left_anti").select("left_id", "region", "k"), "rest")
    of_name = stored(r.filter(F.col("turn") == last).groupBy("region", F.col("k").alias("rk")).agg(F.min("right_id").alias("right_id")), "of_name")
    scored = containing(rest, of_name, "region").withColumn("score", containment(F.col("k"), F.col("rk"))).filter(F.col("score") >= least)
    of_text = scored.join(of_name.hint("merge"), ["region", "rk"]).groupBy("region", "k").agg(F.min(F.struct((-F.col("score")).alias("far"), "right_id")).alias("b"))
    closest = rest.join(of_text.hint("merge"), ["region", "k"]).groupBy("left_id").agg(F.min("b").alias("b"))
    return found.unionByName(closest.select("left_id", "b.right_id", F.lit("containment").alias("tier")))


def _by_tier(rows: DataFrame, ident: str, keys: Sequence[Key]) -> DataFrame:
    """(ident, region, turn, k): each row's keys, one row for each tier that gives one."""
    region = F.col("region") if "region" in rows.columns else F.lit(None).cast("string")
    wide = rows.select(ident, region.alias("region"), *[key(F.col("name")).alias(f"k{i}") for i, key in enumerate(keys)])
    return wide.select(ident, "region", F.posexplode(F.array(*[f"k{i}" for i in range(len(keys))])).alias("turn", "k")).filter("k <> ''")


def unconflicted(matches: DataFrame, tiers: Sequence[str], code: str = "right_id") -> DataFrame:
    """UPD-06, T10: matches of the given tiers whose code no other match of any tier claims."""
    claims = F.count("*").over(Window.partitionBy(code))
    return matches.withColumn("_claims", claims).filter((F.col("_claims") == 1) & F.col("tier").isin(*tiers)).drop("_claims")


def unique_match(left: DataFrame, right: DataFrame, tiers: Sequence[tuple[str, Key]], least_length: int = 2) -> DataFrame:
    """JOIN-07, JOIN-08, JOIN-14: (left_id, right_id, tier) by keys that stand for one right row only."""
    keys = [key for _, key in tiers]
    r = _by_tier(right, "right_id", keys).filter(F.length("k") >= least_length)
    only = r.groupBy("turn", "k").agg(F.min("right_id").alias("right_id"), F.max("right_id").alias("last")).filter("right_id = last")
    best = _by_tier(left, "left_id", keys).join(only, ["turn", "k"]).groupBy("left_id").agg(F.min(F.struct("turn", "right_id")).alias("b"))
    return best.select("left_id", "b.right_id", F.array(*[F.lit(name) for name, _ in tiers])[F.col("b.turn")].alias("tier"))


def unique_containment(left: DataFrame, right: DataFrame, block: str, key: Key, least_length: int) -> DataFrame:
    """JOIN-08: the one right row of the block whose key holds the left one or is held by it; none if there are more."""
    l = left.select("left_id", block, key(F.col("name")).alias("k")).filter(F.length("k") >= least_length)
    r = right.select("right_id", block, key(F.col("name")).alias("rk")).filter(F.length("rk") >= least_length)
    of_name = r.groupBy(block, "rk").agg(F.min("right_id").alias("first"), F.max("right_id").alias("last"))
    ends = lambda rows, *by: rows.groupBy(*by).agg(F.min("first").alias("first"), F.max("last").alias("last"))
    of_text = ends(containing(l, r, block).join(of_name.hint("merge"), [block, "rk"]), block, "k")
    return ends(l.join(of_text.hint("merge"), [block, "k"]), "left_id").filter("first = last").select("left_id", F.col("first").alias("right_id"))


def greedy_codes(entities: DataFrame, targets: DataFrame, used: DataFrame, least: float = 0.6) -> DataFrame:
    """JOIN-06: (entity_id, code, tier): codes handed out in the order of entity_id, each exact one once.

    entities: entity_id, name, region; targets: code, name, region, position; used: code.  First by name and region:
    an entity can claim only the first target of its key, so a code goes to the lowest entity that claims it.  Then by
    containment inside the region, with codes that are still free for the entity: not used before, and not claimed by an
    entity that stood before it.  An entity gets the best score, ties to the earlier target.  These are proposals for
    review: they use up no code, so two entities may be offered the same one.
    """
    first = targets.groupBy("name", "region").agg(F.min(F.struct("position", "code"))["code"].alias("code"))
    claims = entities.join(first, ["name", "region"]).join(used, "code", "left_anti").select("entity_id", "code")
    # what the second step rests on several times is worked out once
    exact = stored(claims.groupBy("code").agg(F.min("entity_id").alias("entity_id")).withColumn("tier", F.lit("exact")), "exact")
    rest = stored(entities.join(exact.select("entity_id"), "entity_id", "left_anti").select("entity_id", F.col("name").alias("k"), "region"), "rest")
    taken = exact.select("code", F.col("entity_id").alias("taken_by"))
    free = stored(targets.join(used, "code", "left_anti"), "free")
    placed = free.select("code", "region", F.col("name").alias("rk")).distinct().join(free.groupBy("code").agg(F.min("position").alias("position")).hint("merge"), "code").join(taken.hint("merge"), "code", "left")
    # all who are free to take it rank a name's codes alike: of those that nobody claims the first is enough
    by_place = F.min(F.struct("position", "code"))
    open_codes = placed.filter("taken_by IS NULL").groupBy("region", "rk").agg(by_place.alias("b")).select("region", "rk", "b.position", "b.code", F.lit(None).cast(taken.schema["taken_by"].dataType).alias("taken_by"))
    codes = open_codes.unionByName(placed.filter("taken_by IS NOT NULL").select("region", "rk", "position", "code", "taken_by"))
    scored = containing(rest, free.select("region", F.col("name").alias("rk")), "region").withColumn("score", containment(F.col("k"), F.col("rk"))).filter(F.col("score") >= least)
    ranked = scored.join(codes.hint("merge"), ["region", "rk"]).select("region", "k", F.struct((-F.col("score")).alias("far"), "position", "code").alias("b"), "taken_by")
    best_open = ranked.filter("taken_by IS NULL").groupBy("region", "k").agg(F.min("b").alias("b"))
    offers = rest.join(best_open.hint("merge"), ["region", "k"]).select("entity_id", "b")
    claimed = ranked.filter("taken_by IS NOT NULL").join(best_open.select("region", "k", F.col("b").alias("other")).hint("merge"), ["region", "k"], "left").filter("other IS NULL OR b < other")
    # in their order, those that a later entity holds than all before; the others are never the first that is free
    before = Window.partitionBy("region", "k").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    claimed = claimed.withColumn("_held", F.max("taken_by").over(before)).filter("_held IS NULL OR taken_by > _held").select("region", "k", "b", "taken_by")
    offers = offers.unionByName(rest.join(claimed.hint("merge"), ["region", "k"]).filter("taken_by > entity_id").select("entity_id", "b"))
    best = offers.groupBy("entity_id").agg(F.min("b").alias("b"))
    return exact.select("entity_id", "code", "tier").unionByName(best.select("entity_id", "b.code", F.lit("containment").alias("tier")))


def set_difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """SET-03, JOIN-24: keys of the left that the right lacks."""
    return left.select(key).distinct().join(right.select(key).distinct(), key, "left_anti")


def proposals(missing: DataFrame, known: DataFrame, key: Key) -> DataFrame:
    """JOIN-15, JOIN-17, CLS-15: for each missing (left_id, name), how many known names share its key, and the lowest."""
    k = known.select(key(F.col("name")).alias("k"), "right_id").filter("k IS NOT NULL AND right_id IS NOT NULL").distinct()
    # a right_id of several keys counts once where a left_id has them; only those are paired one by one
    marked = k.join(k.groupBy("right_id").agg((F.count("*") > 1).alias("many")).hint("merge"), "right_id")
    of_key = marked.groupBy("k").agg(F.count_if(~F.col("many")).alias("n"), F.min("right_id").alias("right_id"))
    asked = missing.select("left_id", key(F.col("name")).alias("k")).distinct().withColumn("_keys", F.count("k").over(Window.partitionBy("left_id")))
    many = marked.filter("many").select("k", F.col("right_id").alias("_r"))
    none = F.lit(None).cast(known.schema["right_id"].dataType).alias("right_id")
    counts = asked.join(of_key, "k", "left").select("left_id", "n", "right_id")
    alone = asked.filter("_keys <= 1").join(many.groupBy("k").agg(F.count("*").alias("n")), "k").select("left_id", "n", none)
    several = asked.filter("_keys > 1").join(many.hint("merge"), "k").groupBy("left_id").agg(F.count_distinct("_r").alias("n")).select("left_id", "n", none)
    out = counts.unionByName(alone).unionByName(several).groupBy("left_id").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("matches"), F.min("right_id").alias("right_id"))
    return out.withColumn("proposal", F.when(F.col("matches") == 0, "no_candidate").when(F.col("matches") == 1, "auto_alias").otherwise("ambiguous"))


#: A text that is part of another must have so many letters.
LEAST_PART = 4


def suffix_variants(name: Column) -> Column:
    """A squeezed unit's name, and the name with its ending swapped for the other that units have."""
    short = F.when(name.endswith("学科"), F.regexp_replace(name, "学科$", "科"))
    long = F.when(name.endswith("科"), F.regexp_replace(name, "科$", "学科"))
    return F.array_compact(F.array(name, short, long))


def unit_aliases(missing: DataFrame, known: DataFrame) -> DataFrame:
    """JOIN-15: (left_id, right_id, tier): known units of the same entity that a missing name may stand for, all those of
    the first tier that has any: suffix (the name, or with its ending swapped), part (one of these holds the known name or
    is held by it, if it has LEAST_PART letters), kana (equal but for long vowels and small i).

    missing: left_id, entity_id, name; known: right_id, entity_id, name.  Empty and null names match nothing, and a name
    of one letter is no part of another.
    """
    # names are folded once; all joins are merges, as in held_names
    l = stored(missing.select("left_id", "entity_id", squeezed(F.col("name")).alias("t"), kana_folded(F.col("name")).alias("kana")).filter("t <> ''"), "missing")
    r = stored(known.select("right_id", "entity_id", squeezed(F.col("name")).alias("d"), kana_folded(F.col("name")).alias("kana")).filter("d <> ''"), "known")
    variants = l.select("left_id", "entity_id", F.explode(suffix_variants(F.col("t"))).alias("v"))
    suffix = variants.join(r.withColumnRenamed("d", "v").hint("merge"), ["entity_id", "v"]).select("left_id", "right_id", F.lit(0).alias("turn"))
    long = variants.filter(F.length("v") >= LEAST_PART)
    side = lambda df, ident, c, names: df.select(F.col(ident).alias(names[0]), "entity_id", F.col(c).alias(names[1]))
    inner, outer = ("inner_id", "k"), ("outer_id", "rk")
    held = held_texts(side(long, "left_id", "v", inner), side(r, "right_id", "d", outer), "entity_id").select(F.col("inner_id").alias("left_id"), F.col("outer_id").alias("right_id"))
    holds = held_texts(side(r, "right_id", "d", inner), side(long, "left_id", "v", outer), "entity_id").select(F.col("outer_id").alias("left_id"), F.col("inner_id").alias("right_id"))
    part = held.unionByName(holds).withColumn("turn", F.lit(1))
    kana = l.filter("kana <> ''").join(r.hint("merge"), ["entity_id", "kana"]).select("left_id", "right_id", F.lit(2).alias("turn"))
    every = suffix.unionByName(part).unionByName(kana).groupBy("left_id", "right_id").agg(F.min("turn").alias("turn"))
    first = every.withColumn("_first", F.min("turn").over(Window.partitionBy("left_id"))).filter("turn = _first")
    return first.select("left_id", "right_id", F.get(F.array(*map(F.lit, ("suffix", "part", "kana"))), F.col("turn")).alias("tier"))


# What a name ends in, or holds in brackets, if it is a branch.
BRANCH = "(分校|校舎|キャンパス|サテライト|[^学大高]校)$"


def branch_of(name: Column) -> Column:
    """The part of a squeezed name that marks a branch: a bracket, or a word before a branch's ending; empty if none."""
    bracket = F.regexp_extract(name, r"\(([^()]+)\)", 1)
    place = F.regexp_extract(F.regexp_replace(name, r"\([^()]*\)", ""), "(?:学校|大学|学院|学園)(.+)$", 1)
    return F.when(place.rlike(BRANCH), place).when(bracket.rlike(BRANCH), bracket).otherwise(F.lit(""))


def template_aliases(missing: DataFrame, known: DataFrame) -> DataFrame:
    """JOIN-14: (left_id, right_id, tier) for a template's missing names: the one known name that is the same, the same
    without brackets, or the same without its institution's suffix.  A branch is never an alias of its parent or of
    another branch."""
    bare = lambda c: F.regexp_replace(squeezed(c), r"\([^()]*\)", "")
    tiers = [("exact", squeezed), ("bracket", bare), ("suffix", lambda c: institution_key(bare(c)))]
    found = unique_match(missing, known, tiers)
    marks = found.join(missing.select("left_id", branch_of(squeezed(F.col("name"))).alias("_b")), "left_id").join(known.select("right_id", branch_of(squeezed(F.col("name"))).alias("_p")), "right_id")
    return marks.filter("_b = _p").select("left_id", "right_id", "tier")


def unit_groups(lumped: DataFrame, units: DataFrame) -> DataFrame:
    """JOIN-16: units of the same entity that belong to a lumped one, by a track that both name."""
    told = lambda rows, ident: rows.select(ident, "entity_id", F.explode("tracks").alias("track")).filter("entity_id IS NOT NULL AND track IS NOT NULL")
    # lumped ones of the same tracks have the same units, which are looked up and listed once
    alike = told(lumped, "left_id").groupBy("left_id").agg(F.sort_array(F.collect_set(F.struct("entity_id", "track"))).alias("kind"))
    tracks = alike.select("kind").distinct().select("kind", F.explode("kind").alias("t")).select("kind", "t.entity_id", "t.track")
    listed = tracks.join(told(units, "right_id").hint("merge"), ["entity_id", "track"]).groupBy("kind").agg(F.array_join(F.sort_array(F.collect_set(F.col("right_id").cast("string"))), ",").alias("unit_ids"))
    return alike.join(listed.hint("merge"), "kind").select("left_id", "unit_ids")


def new_ids(unmatched: DataFrame, key: Sequence[str], after: int, parts: int = 64) -> DataFrame:
    """JOIN-09: unmatched with new_id: ids for what no tier has found, one for each key in the order of keys, nulls first,
    counted on from after.

    Keys are parted by ranges and counted there; a part's ids begin where those of the parts before it end, so no task
    sees all keys.  The parts, at most so many rows, are the only thing that is broadcast.
    """
    ranged = unmatched.select(*key).distinct().repartitionByRange(parts, *key)
    # ranges follow a sample, so they are kept as they fell
    keys = stored(ranged.select(*[F.col(k).alias(f"_{k}") for k in key], F.spark_partition_id().alias("_part")), "keys")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = keys.groupBy("_part").agg(F.count("*").alias("_n")).select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = F.row_number().over(Window.partitionBy("_part").orderBy(*[f"_{k}" for k in key]))
    ids = keys.withColumn("_at", within).join(F.broadcast(starts), "_part").withColumn("new_id", F.col("_start") + F.col("_at") + after)
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in key])
    return unmatched.join(ids, same).select(*unmatched.columns, "new_id")
