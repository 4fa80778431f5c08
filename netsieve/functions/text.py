"""Text normalisation, tokens, stems and polarity."""

from __future__ import annotations

import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from netsieve import fixed_values as V
from netsieve.functions.stemming import stem


def replace_entities(text: Column) -> Column:
    """Lower-case; addresses, interface names and error codes become tokens; null becomes ''."""
    out = F.lower(F.coalesce(text, F.lit("")))
    out = F.regexp_replace(out, V.LOOSE_IP, "IP_ADDRESS")
    out = F.regexp_replace(out, V.INTERFACE_TOKEN, "INTERFACE_NAME")
    return F.regexp_replace(out, V.ERROR_CODE, "ERROR_CODE")


def drop_symbols(text: Column) -> Column:
    """Keep word characters, white space and ``- _ / :``."""
    return F.regexp_replace(text, V.SYMBOLS, " ")


def tokens(text: Column) -> Column:
    """White-space tokens; a colon that no digit follows, a double dash and the joined
    forms the toolkit tokenizer splits are cut apart."""
    out = F.regexp_replace(text, r":(?!\d)|--", " ")
    out = F.regexp_replace(out, V.JOINED_FORMS, "$1 $2")
    return F.regexp_extract_all(out, F.lit(r"\S+"), F.lit(0))


def keep_words(words: Column, general=V.GENERAL_STOP_WORDS, network=V.NETWORK_STOP_WORDS) -> Column:
    stop = list(general) + list(network)
    return F.filter(words, lambda w: (F.length(w) > 2) & ~w.isin(stop))


@F.arrow_udf(StringType())
def stemmed_text(words: pa.Array) -> pa.Array:
    """Each list's words stemmed and joined by blanks; a batch stems its distinct words once."""
    flat = words.flatten().dictionary_encode()
    stems = pa.array([None if w is None else stem(w) for w in flat.dictionary.to_pylist()], pa.string())
    ends = np.cumsum(pc.fill_null(pc.list_value_length(words), 0).to_numpy(), dtype=np.int32)
    offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
    joined = pc.binary_join(pa.ListArray.from_arrays(offsets, stems.take(flat.indices)), " ")
    return pc.if_else(words.is_valid(), joined, pa.scalar(None, pa.string()))


@F.arrow_udf(StringType())
def strip_accents(text: pa.Array) -> pa.Array:
    """Texts without combining marks; Python looks only at the distinct texts beyond ASCII."""
    plain = pc.fill_null(pc.string_is_ascii(text), True)
    if pc.all(plain).as_py() is not False:
        return text
    odd = text.filter(pc.invert(plain)).dictionary_encode()
    bare = ["".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c)) for s in odd.dictionary.to_pylist()]
    return pc.replace_with_mask(text, pc.invert(plain), pa.array(bare, pa.string()).take(odd.indices).cast(text.type))


def kept_tokens(text: Column) -> Column:
    """Tokens of a message after normalising and stop-word removal, before stemming."""
    return keep_words(tokens(drop_symbols(replace_entities(text))))


def processed_message(text: Column) -> Column:
    """The whole normalisation: entities, symbols, tokens, stop words, stems."""
    return stemmed_text(kept_tokens(text))


def preview(text: Column, size: int = 100) -> Column:
    return F.concat(F.substring(text, 1, size), F.lit("..."))


def sentiment_label(score: Column) -> Column:
    return F.when(score > 0.1, "positive").when(score < -0.1, "negative").otherwise("neutral")


def term_frequencies(df: DataFrame, words: Column) -> DataFrame:
    """``(term, n, documents)``: total count and number of rows per term."""
    per_row = df.select(F.array_distinct(words).alias("_set"), words.alias("_words"))
    # count inside the row first: one output row per distinct term of a message
    exploded = per_row.select("_words", F.explode("_set").alias("term"))
    counted = exploded.select("term", F.size(F.filter("_words", lambda w: w == F.col("term"))).alias("c"))
    return counted.groupBy("term").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("documents"))
