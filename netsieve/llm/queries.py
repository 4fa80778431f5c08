"""Queries of the operators for training data, and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netsieve.llm import chat, decontaminate, language, line_dedup, near_dedup, neighbours, packing, resampling, runs, sql, toxicity, trie, url_rules, warc
from netsieve.llm.store import new_folder, stored


def _table(spark, sf_dir, name) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op2_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.write_bundles(_table(spark, sf_dir, "pages"), new_folder(spark, "warc"))
    found = warc.read_bundles(spark, index)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.drop_repeated_lines(docs)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = language.fit_languages(docs.where(~held_out))
    return language.predict_languages(docs.select("doc_id", "text", held_out.alias("held_out")), model).drop("text")


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "\\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], turns.schema)
    return chat.digest_chats(stored(chat.format_chats(turns.union(more)), "chats"))


def op7_minhash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"), width=4)


# host, path, verdict
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op8_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return url_rules.judge_urls(_table(spark, sf_dir, "pages").select("page_id", "url"), rules).drop("url")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_passages(docs, _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        F.size("hit_words").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("hit_words") > 0).alias("contaminated"),
    )


def op10_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = runs.periodic_runs(docs.withColumn("text", F.coalesce(_with_planted_run(F.col("doc_id"), F.col("text")), F.lit(""))))
    ordered = F.sort_array(F.transform("runs", lambda r: F.struct((-r["length"]).alias("n"), r["start"].alias("start"), r["period"].alias("period"))))
    longest = F.get(ordered, 0)
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        longest["start"].alias("start"),
        (-longest["n"]).alias("length"),
        longest["period"].alias("period"),
        F.floor(-longest["n"] * 1000 / longest["period"]).alias("exponent_milli"),
        F.sha2(F.concat_ws("", F.transform(lines, lambda x: F.concat(x, F.lit("\n")))), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def _with_planted_run(doc_id, text):
    """``text``, for about a tenth of the ids with its words repeated from one place on."""
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)

    def planted(ws):
        n = F.size(ws)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        return F.array_join(F.transform(ws, lambda w, i: F.when(i < a, w).otherwise(F.element_at(ws, (a + (i - a) % p + 1).cast("int")))), " ")

    # in an array of one, so that the words are split once
    split = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return F.when((h % 10 == 0) & text.rlike(r"[^\x20\x09-\x0D]"), F.transform(F.array(split), planted)[0]).otherwise(text)


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns, pieces = trie.number_turns(trie.digest_turns(_table(spark, sf_dir, "conversations")))
    # every conversation takes its first turns from the first of five
    sizes = pieces.groupBy("conv_id").agg(F.max("n_turns").alias("n"))
    head = F.crc32(F.col("conv_id").cast("string")) % 9
    plan = sizes.select("conv_id", (F.col("conv_id") - F.col("conv_id") % 5).alias("base"), head.alias("head"))
    plan = plan.join(sizes.select(F.col("conv_id").alias("base"), "n"), "base", "left")
    plan = stored(plan.select("conv_id", "base", "head", F.least("head", F.coalesce("n", F.lit(0))).alias("taken")), "plan")
    own = turns.join(pieces.select("conv_id", "piece").join(plan, "conv_id"), ["conv_id", "piece"]).where("pos >= head")
    own = own.select("conv_id", (F.col("pos") - F.col("head") + F.col("taken")).alias("pos"), "key", "n_bytes")
    shared = turns.where("pos < 8 and conv_id % 5 = 0").withColumnRenamed("conv_id", "base").join(plan, "base").where("pos < taken")
    return trie.build_trie(own.unionByName(shared.select(own.columns)), plan.select("conv_id"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = toxicity.fit_toxicity(docs, _table(spark, sf_dir, "labels").where(~held_out))
    return toxicity.score_toxicity(docs.withColumn("held_out", held_out), model).drop("text")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict:
    named = (
        op1_best_fit_packing, op2_importance_resampling, op3_warc_bundles, op4_line_dedup, op5_language_id, op6_chat_formatting,
        op7_minhash_forest, op8_url_rules, op9_decontamination, op10_nearest_vectors, op11_periodic_runs, op12_conversation_trie,
        op13_toxicity, pipeline,
    )
    return {f.__name__: f for f in named}


def oracle_sql() -> dict:
    return {
        "op3_warc_bundles": sql.OP3,
        "op4_line_dedup": sql.OP4,
        "op6_chat_formatting": sql.OP6,
        "op7_minhash_forest": sql.OP7,
        "op8_url_rules": sql.OP8,
        "op9_decontamination": sql.OP9,
        "op10_nearest_vectors": sql.OP10,
        "op12_conversation_trie": sql.OP12,
    }
