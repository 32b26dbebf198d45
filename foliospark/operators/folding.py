"""Folding the patch log into records.

Every patch becomes attempts to write single fields, and every field of a case has its own history: windows over (case_id, field) in
order of seq say which attempts a person's decision refuses, and what stands at the end. Quotes are intervals from the patch that
brings them to the one that drops them; a dropped quote empties the fields that no living quote supports. No case is gathered into a group of its own.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.operators.ledger import kind
from foliospark.session import written

#: The judged fields, and which of them a quote must support, by the version of the prompt that a record was read with ('' for none).
JUDGED = (
    "relevant", "polarity", "who_was_letting", "duration_of_occupancy", "characterization",
    "holding_summary", "under_thirty_days", "restriction_nature", "owner_freedom_characterization",
)
THREE = ("characterization", "polarity", "holding_summary")
SIX = ("characterization", "polarity", "holding_summary", "owner_freedom_characterization", "restriction_nature", "under_thirty_days")
SUPPORTED = {"": THREE, "mapper-v1": THREE, "mapper-v2": SIX, "mapper-v3": SIX}
FLAG = "needs-review:"
OPS = ("admit", "set", "append", "drop_quote", "migrate")
BODY_LISTS = ("quotes", "nulled_fields")


@dataclass
class Folded:
    """records: case_id, cycle, admit_seq, in_file, fields (name -> JSON text, without nulls), quotes (JSON texts), nulled_fields, flags, provenance.

    conflicts: case_id, field, attempted, standing, seq, historical. errors: case_id, seq, error.
    """

    records: DataFrame
    conflicts: DataFrame
    errors: DataFrame


def _json(value: Column) -> Column:
    """JSON text of a variant; null for JSON null."""
    text = F.to_json(value)
    return F.when(text != "null", text)


def _supports(quote: Column) -> Column:
    """The fields that a quote's JSON text says it supports: a text or a list of texts."""
    one = F.get_json_object(quote, "$.supports")
    return F.filter(F.coalesce(F.from_json(one, "array<string>"), F.array(one)), lambda x: x.isNotNull() & (x != ""))


def judged_patches(log: DataFrame) -> DataFrame:
    """The log with first_cycle, admit_seq, epoch (admissions so far), and `error` for patches that can't apply."""
    admit = F.col("op") == "admit"
    first = log.filter(admit).groupBy("case_id").agg(F.min(F.struct("seq", "cycle")).alias("first"))
    d = log.join(first, "case_id", "left")
    can_judge = F.col("reviewer").isNotNull() | (F.col("model").isNotNull() & F.col("prompt_version").isNotNull() & F.col("run_id").isNotNull())
    is_null = F.col("new").isNull() | (F.trim("new") == "null")
    error = (
        F.when(~F.col("op").isin(*OPS), F.concat(F.lit("unknown op "), F.col("op")))
        .when(F.col("first").isNull() | (F.col("seq") < F.col("first.seq")), "unknown case")
        .when(admit & ~F.col("cycle").eqNullSafe(F.col("first.cycle")), F.concat(F.lit("admitted in "), F.col("first.cycle"), F.lit(" already")))
        .when((F.col("op") == "set") & F.col("field").isin(*JUDGED) & ~is_null & ~can_judge, F.concat("field", F.lit(" needs a basis")))
    )
    d = d.withColumn("error", error).withColumn("admit_seq", F.col("first.seq")).withColumn("first_cycle", F.col("first.cycle")).drop("first")
    sofar = Window.partitionBy("case_id").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    return d.withColumn("epoch", F.count_if(admit & F.col("error").isNull()).over(sofar))


def quote_lives(patches: DataFrame) -> DataFrame:
    """case_id, quote (JSON text), text, supports, added and place of every quote, and removed: the seq that drops it or replaces its record, null while it lives."""
    listed = F.from_json(F.get_json_object("new", "$.quotes"), "array<variant>")
    brought = patches.filter("op = 'admit'").select("case_id", "seq", F.posexplode(F.transform(listed, lambda q: F.to_json(q))).alias("place", "quote"))
    brought = brought.unionByName(patches.filter("op = 'append' and field = 'quotes'").select("case_id", "seq", F.lit(0).alias("place"), F.col("new").alias("quote")))
    text = F.get_json_object("quote", "$.text")
    rows = brought.select("case_id", "seq", "place", "quote", text.alias("text"), F.lit(None).cast("long").alias("ends"))
    dropped = patches.filter("op = 'drop_quote'").select("case_id", "seq", F.get_json_object(F.concat(F.lit('{"t":'), "new", F.lit("}")), "$.t").alias("text"), F.col("seq").alias("ends"))
    later = Window.partitionBy("case_id", "text").orderBy("seq").rowsBetween(1, Window.unboundedFollowing)
    lives = rows.unionByName(dropped, allowMissingColumns=True).withColumn("drop", F.min("ends").over(later)).filter("quote is not null").drop("ends")
    replaced = patches.filter("op = 'admit'").select("case_id", "seq", F.lead("seq").over(Window.partitionBy("case_id").orderBy("seq")).alias("next"))
    epochs = patches.select("case_id", "seq", "epoch")
    ends = epochs.join(patches.filter("op = 'admit'").select("case_id", F.col("epoch"), F.col("seq").alias("opened")), ["case_id", "epoch"]).join(replaced.withColumnRenamed("seq", "opened"), ["case_id", "opened"])
    lives = lives.join(ends.select("case_id", "seq", "next"), ["case_id", "seq"], "left")
    return lives.select("case_id", "quote", "text", _supports(F.col("quote")).alias("supports"), F.col("seq").alias("added"), "place", F.least("drop", "next").alias("removed"))


def cascades(patches: DataFrame, lives: DataFrame) -> DataFrame:
    """(case_id, field, seq) of the fields that a drop_quote leaves without a living quote, of those that the record's prompt wants supported."""
    judged_set = (F.col("op") == "set") & F.col("field").isin(*JUDGED)
    sofar = Window.partitionBy("case_id").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    version = F.nullif(F.col("prompt_version"), F.lit(""))
    admitted = F.last(F.when(F.col("op") == "admit", version), ignorenulls=True).over(sofar)
    spoken = F.first(F.when(judged_set, version), ignorenulls=True).over(sofar)
    prompt = F.split_part(F.coalesce(admitted, spoken, F.lit("")), F.lit(":"), F.lit(1))
    wanted = F.create_map(*(x for k, v in SUPPORTED.items() for x in (F.lit(k), F.array(*map(F.lit, v)))))
    known = F.coalesce(F.try_element_at(wanted, F.col("prompt")), F.raise_error(F.concat(F.lit("unknown prompt version "), "prompt")).cast("array<string>"))
    probes = patches.withColumn("prompt", prompt).filter("op = 'drop_quote'").select("case_id", "seq", F.explode(known).alias("field"))
    each = lives.select("case_id", F.explode(F.array_distinct("supports")).alias("field"), "added", "removed")
    steps = each.select("case_id", "field", F.col("added").alias("seq"), F.lit(1).alias("step")).unionByName(each.filter("removed is not null").select("case_id", "field", F.col("removed").alias("seq"), F.lit(-1).alias("step")))
    rows = steps.withColumn("probe", F.lit(False)).unionByName(probes.withColumn("step", F.lit(0)).withColumn("probe", F.lit(True)))
    alive = F.sum("step").over(Window.partitionBy("case_id", "field").orderBy("seq").rangeBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("alive", alive).filter("probe and alive = 0").select("case_id", "field", "seq")


def attempts(patches: DataFrame, cascaded: DataFrame) -> DataFrame:
    """(case_id, field, seq, how, value, human, speaks): what patches do to single fields. how: write, replace (by a body without the field), fill or cascade."""
    who = [F.col("reviewer").isNotNull().alias("human"), kind().alias("speaks")]
    body = lambda path: F.map_entries(F.from_json(path, "map<string,variant>"))
    admits = patches.filter("op = 'admit'")
    named = admits.select("case_id", "seq", *who, F.explode(body(F.col("new"))).alias("e")).select("case_id", F.col("e.key").alias("field"), "seq", F.lit("write").alias("how"), _json(F.col("e.value")).alias("value"), "human", "speaks")
    named = named.filter(~F.col("field").isin("review", *BODY_LISTS))
    review = admits.select("case_id", "seq", *who, F.explode(body(F.get_json_object("new", "$.review"))).alias("e")).select("case_id", F.concat(F.lit("review."), "e.key").alias("field"), "seq", F.lit("write").alias("how"), _json(F.col("e.value")).alias("value"), "human", "speaks")
    sets = patches.filter("op = 'set'").select("case_id", "field", "seq", F.lit("write").alias("how"), F.when(F.trim("new") != "null", F.col("new")).alias("value"), *who)
    fills = patches.filter("op = 'migrate'").select("case_id", "seq", *who, F.explode(body(F.col("new"))).alias("e"))
    fills = fills.select("case_id", F.col("e.key").alias("field"), "seq", F.when(F.col("e.key") == "schema_version", "write").otherwise("fill").alias("how"), _json(F.col("e.value")).alias("value"), "human", "speaks")
    told = named.unionByName(review).unionByName(sets).unionByName(fills)
    # a body that doesn't name a field that the case had empties it
    fields = told.select("case_id", "field").distinct()
    silent = admits.filter("epoch > 1").select("case_id", "seq", *who).join(fields, "case_id").join(named.unionByName(review).select("case_id", "field", "seq"), ["case_id", "field", "seq"], "left_anti")
    silent = silent.select("case_id", "field", "seq", F.lit("replace").alias("how"), F.lit(None).cast("string").alias("value"), "human", "speaks")
    nulls = cascaded.select("case_id", "field", "seq", F.lit("cascade").alias("how"), F.lit(None).cast("string").alias("value"), F.lit(False).alias("human"), F.lit(None).cast("string").alias("speaks"))
    return told.unionByName(silent).unionByName(nulls)


def histories(tries: DataFrame, protect_from: int) -> DataFrame:
    """tries with decided (a person has spoken before), standing (the value before) and applied."""
    judged = F.col("field").isin(*JUDGED)
    field = Window.partitionBy("case_id", "field").orderBy("seq", "how")
    before = field.rowsBetween(Window.unboundedPreceding, -1)
    d = tries.withColumn("decided", judged & F.coalesce(F.max(F.col("human") & (F.col("how") == "write")).over(before), F.lit(False)))
    free = F.col("human") | ~F.col("decided")
    applied = F.when(F.col("how") == "cascade", True).when(F.col("how") == "fill", False).otherwise(free | (F.col("seq") <= protect_from))
    d = d.withColumn("applied", applied)
    standing = F.last(F.when(F.col("applied"), F.struct("value")), ignorenulls=True).over(before)
    return d.withColumn("standing", standing["value"])


def fold(log: DataFrame, protect_from: int) -> Folded:
    """The records after all patches of the log (seq, case_id, cycle, op, field, new as JSON text, reviewer, model, prompt_version, run_id, rule_id).

    A person's value stands against writes of others with a seq above protect_from: those are conflicts, and flag the record. Up to it they apply, and
    are historical conflicts. An equal value is neither. A re-admission replaces the record, but for what stands; dropping a quote empties fields
    that no living quote supports, whoever set them. Patches that can't apply are errors and change nothing: unknown ops, cases not admitted yet, a second
    cycle, judged values without a reviewer or a complete reading. The tables written on the way stay in the shared folder.
    """
    judged = written(judged_patches(log), "fold-patches")
    patches = judged.filter("error is null")
    lives = written(quote_lives(patches), "fold-quotes")
    tries = written(histories(attempts(patches, cascades(patches, lives)), protect_from), "fold-fields")
    opened = patches.filter("op = 'admit'").groupBy("case_id").agg(
        F.max("seq").alias("opened"), F.first("first_cycle").alias("cycle"), F.first("admit_seq").alias("admit_seq"), F.max_by("new", "seq").alias("body")
    )
    # whether a record is in the file is settled by its last admission, after what a person has said has been put back into the admitted body
    settled = tries.filter("field = 'relevant' and applied").join(opened.select("case_id", "opened"), "case_id").filter("seq <= opened").groupBy("case_id").agg(F.max(F.struct("seq", "value"))["value"].alias("relevant"))
    last = F.max(F.when(F.col("applied"), F.struct("seq", "value")))
    ends = tries.groupBy("case_id", "field").agg(
        last.alias("last"),
        F.collect_list(F.when(F.col("how") == "fill", F.struct("seq", "value"))).alias("fills"),
        F.max(F.col("human") & (F.col("how") == "write")).alias("by_human"),
        F.max_by("speaks", F.when((F.col("how") == "write") & F.col("applied"), F.col("seq"))).alias("speaks"),
    )
    filled = F.array_sort(F.filter("fills", lambda x: F.col("last.seq").isNull() | (x["seq"] > F.col("last.seq"))))
    ends = ends.withColumn("value", F.coalesce("last.value", F.get(filled, F.lit(0))["value"]))
    conflict = (F.col("how") == "write") & ~F.col("human") & F.col("decided") & ~F.col("standing").eqNullSafe(F.col("value"))
    conflicts = tries.filter(conflict).select("case_id", "field", F.col("value").alias("attempted"), "standing", "seq", (F.col("seq") <= protect_from).alias("historical"))
    by_case = ends.groupBy("case_id").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("value").isNotNull() & (F.col("field") != "review.flags"), F.struct("field", "value"))))).alias("fields"),
        F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("field").isin(*JUDGED) & F.col("speaks").isNotNull(), F.struct("field", F.when(F.col("by_human"), "human").otherwise(F.col("speaks")).alias("who")))))).alias("provenance"),
        F.max(F.when(F.col("field") == "review.flags", F.col("value"))).alias("flags"),
    )
    quotes = lives.filter("removed is null").groupBy("case_id").agg(F.array_sort(F.collect_list(F.struct("added", "place", "quote"))).alias("q"))
    emptied = tries.filter("how = 'cascade' and standing is not null").join(opened.select("case_id", "opened"), "case_id").filter("seq > opened")
    emptied = emptied.groupBy("case_id").agg(F.array_sort(F.collect_list(F.struct("seq", "field"))).alias("n"))
    raised = conflicts.filter("not historical").join(opened.select("case_id", "opened"), "case_id").filter("seq >= opened").groupBy("case_id").agg(F.array_sort(F.collect_set(F.concat(F.lit(FLAG), "field"))).alias("raised"))
    more = patches.filter("op = 'append' and field = 'review.flags'").join(opened.select("case_id", "opened"), "case_id").filter("seq > opened").groupBy("case_id").agg(F.array_sort(F.collect_list(F.struct("seq", "new"))).alias("m"))
    d = opened.join(settled, "case_id", "left").join(by_case, "case_id", "left").join(quotes, "case_id", "left").join(emptied, "case_id", "left").join(raised, "case_id", "left").join(more, "case_id", "left")
    texts = lambda c: F.coalesce(c, F.array().cast("array<string>"))
    flags = F.array_distinct(F.concat(texts(F.from_json("flags", "array<string>")), texts(F.transform("m", lambda x: F.get_json_object(F.concat(F.lit('{"t":'), x["new"], F.lit("}")), "$.t"))), texts(F.col("raised"))))
    records = d.select(
        "case_id", "cycle", "admit_seq", F.coalesce(F.col("relevant") == "true", F.lit(False)).alias("in_file"),
        F.coalesce("fields", F.create_map().cast("map<string,string>")).alias("fields"),
        texts(F.transform("q", lambda x: x["quote"])).alias("quotes"),
        F.concat(texts(F.from_json(F.get_json_object("body", "$.nulled_fields"), "array<string>")), texts(F.transform("n", lambda x: x["field"]))).alias("nulled_fields"),
        flags.alias("flags"), "provenance",
    )
    return Folded(records, conflicts, judged.filter("error is not null").select("case_id", "seq", "error"))
