"""Figures and tables: rule roles, role domains, model assignments, syncing into records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import text as T
from ..llm.kit import save, small
from .tables import changed_fields, last_wins

# Roles of visual assets.
QUESTION_ROLES = ("stem_figure", "option_figure", "stem_table", "option_table")
ANSWER_ROLES = ("answer_figure", "analysis_figure", "rubric_table")
OPEN_ROLES = ("noise", "uncertain")
# Blocks that have a file, and where in a run's folder it may lie; the last holds files by name alone.
FILED = ("image", "chart", "table", "interline_equation")
SIDES = ("paper", "answer")
FOLDERS = ("", "mineru_extract/", "mineru_extract/images/")
SYNCED = ("visual_assets", "figure_labels", "table_labels", "option_asset_placeholders", "source_answer_labels")


def allowed_roles(mode: Column, stream: Column) -> Column:
    lits = lambda *names: F.array(*(F.lit(n) for n in names))
    every = lits(*QUESTION_ROLES, *ANSWER_ROLES, *OPEN_ROLES)
    return F.when(mode == "mixed", every).when(stream == "answer", lits(*ANSWER_ROLES, *OPEN_ROLES)).otherwise(lits(*QUESTION_ROLES, *OPEN_ROLES))


def role_for(kind: Column, hint: Column) -> Column:
    """The role that a hint names for a kind of asset."""
    table, h = F.lower(F.coalesce(kind, F.lit("image"))) == "table", F.lower(F.coalesce(hint, F.lit("unknown")))
    either = lambda t, f: F.when(table, t).otherwise(f)
    return (
        F.when(h == "option", either("option_table", "option_figure")).when(h == "answer", "answer_figure").when(h == "analysis", "analysis_figure")
        .when(h == "rubric", either("rubric_table", "analysis_figure")).otherwise(either("stem_table", "stem_figure"))
    )


def rule_assets(labels: DataFrame, keys=("run_id", "question_no")) -> DataFrame:
    """Roles of a question's asset blocks (label, type, figure_id, page, x, y): exactly four are the options A to D in reading order, others stand in the stem."""
    a = labels.withColumn("kind", T.asset_kind(F.col("label"), F.col("type"), F.col("figure_id"))).where("kind is not null")
    n = F.count("*").over(Window.partitionBy(*keys))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("page", F.bround(F.col("y") / 80), "x"))
    four = n == 4
    return a.select(
        *keys, "label", "kind", role_for(F.col("kind"), F.when(four, "option").otherwise("stem")).alias("role"),
        F.when(four, F.try_element_at(F.array(*(F.lit(x) for x in "ABCD")), place)).alias("option_label"),
    )


def check_assignments(expected: DataFrame, answers: DataFrame, keys=("run_id", "label")) -> DataFrame:
    """Model answers for the expected assets, normalised: (.., role, question_no, option_label, confidence, problem).

    expected: keys, candidates, allowed. problem says unanswered or bad_role;
    a question that is no candidate makes the asset uncertain.
    """
    j = expected.join(answers, list(keys), "left")
    known = F.array_contains("candidates", F.col("question_no"))
    role = F.when(F.coalesce(known, F.lit(False)) | (F.col("role") == "noise"), F.col("role")).otherwise("uncertain")
    letter = F.upper(T.strip(F.coalesce("option_label", F.lit(""))))
    problem = F.when(F.col("role").isNull(), "unanswered").when(~F.array_contains("allowed", F.col("role")), "bad_role")
    return j.select(
        *keys, F.when(problem.isNull(), role).alias("role"), F.when(known, F.col("question_no")).alias("question_no"),
        F.when(letter.isin(*"ABCD"), letter).alias("option_label"), G.confidence(F.col("confidence").cast("string")).alias("confidence"), problem.alias("problem"),
    )


def placeholders_by_letter(assets: Column) -> Column:
    """Letter to label of the option figures, the last of a letter winning."""
    wanted = F.filter(assets, lambda a: (a["role"] == "option_figure") & a["option_label"].isin(*"ABCD"))
    letters = F.array_distinct(F.transform(wanted, lambda a: a["option_label"]))
    last = lambda k: F.element_at(F.filter(wanted, lambda a: a["option_label"] == k), -1)["label"]
    return F.map_from_entries(F.transform(letters, lambda k: F.struct(k.alias("key"), last(k).alias("value"))))


def attach_assets(rows: DataFrame, assets: DataFrame, run: str = "run_id") -> DataFrame:
    """Rows (run, question_no, labels) without any asset's label, with their own assets in order; the first row of a label wins, noise goes."""
    one = assets.groupBy(run, "label").agg(F.min_by(F.struct("question_no", "role", "option_label", "ordinal"), F.col("ordinal")).alias("a")).select(run, "label", "a.*")
    names = rows.select(run, "question_no", F.posexplode("labels").alias("_i", "label"))
    kept = names.join(one.select(run, "label"), [run, "label"], "left_anti").groupBy(run, "question_no")
    kept = kept.agg(F.transform(F.array_sort(F.collect_list(F.struct("_i", "label"))), lambda x: x["label"]).alias("labels"))
    mine = one.where("role <> 'noise' and question_no is not null").groupBy(run, "question_no")
    mine = mine.agg(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "label", "role", "option_label"))), lambda x: x.dropFields("ordinal")).alias("visual_assets"))
    none = F.array().cast("array<string>")
    out = rows.drop("labels").join(kept, [run, "question_no"], "left").join(mine, [run, "question_no"], "left")
    return out.withColumn("labels", F.coalesce("labels", none))


def upsert_spans(rows: DataFrame, entries: DataFrame, keys=("run_id", "question_no")) -> DataFrame:
    """Answer rows (keys, excerpt, confidence, status) with the last table entry of each question put in: its text, the larger confidence, found."""
    last = last_wins(entries, list(keys), ["ordinal"]).select(*keys, F.col("answer_text").alias("_text"), F.col("confidence").alias("_conf"))
    j = rows.join(last, list(keys), "left")
    hit = F.col("_text").isNotNull()
    return j.select(
        *keys, F.when(hit, T.short_answer(F.col("_text"))).otherwise(F.col("excerpt")).alias("excerpt"),
        F.greatest(F.col("confidence"), F.col("_conf")).alias("confidence"), F.when(hit, "found").otherwise(F.col("status")).alias("status"),
    )


def sync(bank: DataFrame, alignment: DataFrame, key: str = "question_no", fields=SYNCED) -> tuple[DataFrame, DataFrame]:
    """The bank with the alignment's fields and the changes (key, changed); rows without a partner stay."""
    fields = [f for f in fields if f in bank.columns and f in alignment.columns]
    side = alignment.select(F.col(key).alias("_key"), *(F.col(f).alias(f"_{f}") for f in fields))
    j = bank.join(side, bank[key] == side["_key"], "left")
    new = j.select(*(F.when(F.col("_key").isNotNull(), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in fields else F.col(c) for c in bank.columns))
    return new, changed_fields(bank, alignment, key, fields).where("size(changed) > 0")


TABLES = "struct<tables:array<struct<label:string,role:string,entries:array<struct<question_no:string,answer_text:string,confidence:string,reason:string>>,confidence:string,reason:string>>,risks:array<string>>"
TABLE_ROLES = ("answer_key_table", "rubric_table", "solution_table", "noise", "uncertain")


def source_candidates(folder: Column, path: Column) -> Column:
    """Where the file of a layout item may lie in a run's folder, in order."""
    whole = F.replace(path, F.lit("\\"), F.lit("/"))
    name = F.regexp_extract(whole, "[^/]*$", 0)
    return F.array(*(F.concat(folder, F.lit(f"/{side}/{part}"), name if part.endswith("images/") else whole) for side in SIDES for part in FOLDERS))


def asset_map(blocks: DataFrame, layout: DataFrame, listing: DataFrame, run: str = "run_id") -> DataFrame:
    """(run, label, source): the file of every label of a block that has one; null where there is none.

    blocks: run, folder, stream, pos, label, type, block_id, figure_id; layout:
    run, stream, key, path, a key once in a run and stream; listing: path. A
    block's item is that of its block_id, else of its figure_id. Of the blocks
    of a label the first whose file exists counts, those of questions first.
    """
    have = F.lower("type").isin(*FILED) & (F.col("label") != "")
    rows = blocks.where(have).select(run, "folder", "stream", "pos", "label", "block_id", "figure_id")
    # Many blocks name one item, and many items one path: items and the files of paths are broadcast where they are few, and
    # candidates are tried a path, not a block.
    items = small(save(layout.where("key <> ''").select(run, "stream", "key", F.nullif("path", F.lit("")).alias("path")), "items"))
    for c in ("block_id", "figure_id"):
        rows = rows.join(items.select(run, "stream", F.col("key").alias(c), F.struct("path").alias(f"_{c}")), [run, "stream", c], "left")
    rows = rows.select(run, "label", "stream", "pos", "folder", F.coalesce("_block_id", "_figure_id")["path"].alias("path"))
    tries = rows.where("folder is not null and path is not null").select("folder", "path").distinct()
    tries = tries.select("folder", "path", F.posexplode(source_candidates(F.col("folder"), F.col("path"))).alias("nth", "source"))
    files = tries.join(listing.select(F.col("path").alias("source")).distinct(), "source").groupBy("folder", "path").agg(F.min_by("source", "nth").alias("source"), F.min("nth").alias("nth"))
    found = rows.join(small(save(files, "files")), ["folder", "path"], "left")
    # Dealt first, so each task sorts its own labels only, however few the splits of the blocks are.
    found = found.repartition(int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")), run, "label")
    best = F.min(F.when(F.col("source").isNotNull(), F.struct((F.col("stream") != "question").alias("side"), "pos", "nth", "source")))
    return found.groupBy(run, "label").agg(best["source"].alias("source"))


def asset_contexts(assets: DataFrame, candidates: DataFrame, prefill: DataFrame, mode: str, run: str = "run_id") -> DataFrame:
    """What a model is asked about a page's assets: (run, stream, page, assets), candidates ranked, prefilled roles kept only where allowed; pages without an asset give no row.

    assets: run, stream, page, label, kind; candidates: run, label, question_no,
    rank, distance; prefill: run, label, role, option_label.
    """
    near = candidates.groupBy(run, "label").agg(F.array_sort(F.collect_list(F.struct("rank", "question_no", "distance"))).alias("candidates"))
    j = assets.join(near, [run, "label"], "left").join(prefill, [run, "label"], "left").withColumn("allowed", allowed_roles(F.lit(mode), F.col("stream")))
    j = j.withColumn("role", F.when(F.array_contains("allowed", F.col("role")), F.col("role")))
    return j.groupBy(run, "stream", "page").agg(F.array_sort(F.collect_list(F.struct("label", "kind", "role", "option_label", "candidates"))).alias("assets"))


def table_contexts(blocks: DataFrame, candidates: DataFrame, run: str = "run_id", limit: int = 2200) -> DataFrame:
    """Answer tables of a page for a model: (run, page, tables) with label, candidates and excerpt; pages without tables give no row."""
    t = blocks.where(T.asset_kind(F.col("label"), F.col("type"), F.col("figure_id")) == "table").join(candidates, [run, "label"], "left")
    row = F.struct("label", F.coalesce("candidates", F.array().cast("array<int>")).alias("candidates"), T.excerpt(F.col("text"), limit).alias("text"))
    return t.groupBy(run, "page").agg(F.array_sort(F.collect_list(row)).alias("tables"))


def _named_tables(responses: DataFrame, run: str, column: str) -> DataFrame:
    """(run, label, role, entries, confidence, reason): of the tables that an answer names, the last of each label; unknown roles are uncertain."""
    t = responses.select(run, F.posexplode(F.from_json(column, TABLES)["tables"]).alias("_i", "t")).where("t.label is not null").select(run, "_i", "t.*")
    t = last_wins(t, [run, "label"], ["_i"])
    name = T.strip(F.col("role"))
    return t.withColumn("role", F.when(name.isin(*TABLE_ROLES), name).otherwise("uncertain"))


def table_roles(responses: DataFrame, contexts: DataFrame, run: str = "run_id", column: str = "response") -> DataFrame:
    """(run, label, role, confidence, reason) of every table asked about (run, tables with labels); one that the answer leaves out is uncertain."""
    asked = contexts.select(run, F.explode("tables").alias("t")).select(run, F.col("t.label").alias("label")).distinct()
    j = asked.join(_named_tables(responses, run, column), [run, "label"], "left")
    return j.select(run, "label", F.coalesce("role", F.lit("uncertain")).alias("role"), G.confidence(F.col("confidence")).alias("confidence"), F.coalesce("reason", F.lit("")).alias("reason"))


def table_entries(responses: DataFrame, candidates: DataFrame, run: str = "run_id", column: str = "response") -> DataFrame:
    """Entries of answer-key tables in model responses: (run, label, role, question_no, answer_text, confidence, ordinal).

    Only answer keys have entries; where a table has candidates, other questions
    go; so do numbers that are none and blank answers. Answers are short
    answers: a single letter is set between dollars.
    """
    t = _named_tables(responses, run, column)
    e = t.where("role = 'answer_key_table'").select(run, "label", "role", "_i", F.posexplode("entries").alias("_j", "e"))
    e = e.withColumn("question_no", F.col("e.question_no").try_cast("int")).where("question_no is not null").join(candidates, [run, "label"], "left")
    e = e.where(F.coalesce(F.size("candidates") <= 0, F.lit(True)) | F.array_contains("candidates", F.col("question_no")))
    e = e.withColumn("answer_text", T.short_answer(F.col("e.answer_text"))).where("answer_text <> ''")
    return e.select(run, "label", "role", "question_no", "answer_text", G.confidence(F.col("e.confidence")).alias("confidence"), F.struct("_i", "_j").alias("ordinal"))
