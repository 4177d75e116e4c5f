"""Named entities by dictionary, and the hook for a model."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T



def words_of(text: Column) -> Column:
    """The lower-cased words of a text."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _run_from(words: Column, n: int):
    return lambda start: F.array_join(F.slice(words, start, F.lit(n)), " ")


def phrases(words: Column, longest: int) -> Column:
    """All runs of one to ``longest`` words.

    ``words`` must be a plain column: an expression here would be evaluated
    again for every run.
    """
    runs = [words]
    for n in range(2, longest + 1):
        starts = F.when(F.size(words) >= n, F.sequence(F.lit(1), F.size(words) - (n - 1))).otherwise(
            F.array().cast("array<int>")
        )
        runs.append(F.transform(starts, _run_from(words, n)))
    return F.concat(*runs)


def _counted(rows: DataFrame) -> DataFrame:
    """(key, phrase, n) from (key, phrases): how often a row holds each phrase.

    Counted a batch of rows at a time where they lie: no table of the phrases of
    a whole partition is held, and none is shuffled.
    """
    key = rows.schema[0]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            encoded = lists.flatten().dictionary_encode()
            known = encoded.dictionary
            row = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
            pairs, n = np.unique(row * len(known) + encoded.indices.to_numpy(), return_counts=True)
            row, code = np.divmod(pairs, max(len(known), 1))
            columns = [batch.column(0).take(pa.array(row)), known.take(pa.array(code)), pa.array(n, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[key.name, "phrase", "n"])

    return rows.mapInArrow(count, T.StructType([key, T.StructField("phrase", T.StringType()), T.StructField("n", T.LongType())]))


def dictionary_entities(
    docs: DataFrame, dictionary: DataFrame, key: str = "doc_id", text: str = "text", longest: int = 1
) -> DataFrame:
    """``(key, label, n)``: how often phrases of each label occur in each document.

    ``dictionary`` holds unique lower-cased ``(phrase, label)`` pairs. Phrases are
    counted in each row before an ordinary join by phrase: the planner
    broadcasts a dictionary that is small by its known size, and else
    splits the partitions of phrases that occur in most documents. Rows of one
    key add up after the join, when what the dictionary does not hold is gone.
    """
    split = docs.select(key, words_of(F.coalesce(F.col(text), F.lit(""))).alias("words"))
    if longest > 1:
        split = split.select(key, phrases(F.col("words"), longest).alias("phrases"))
    tagged = _counted(split).join(dictionary, "phrase")
    return tagged.groupBy(key, "label").agg(F.sum("n").alias("n"))


def entity_maps(counts: DataFrame, key: str = "doc_id") -> DataFrame:
    """One ``map<label, count>`` per document; its size is the number of labels."""
    return counts.groupBy(key).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("label", "n")))).alias("entities")
    )


def model_entities(
    docs: DataFrame,
    load_tagger: Callable[[], Callable[[str], dict[str, int]]],
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``(key, entities)`` from a user's tagger, loaded once per Python worker.

    ``load_tagger`` returns a function from text to label counts; when it
    raises ImportError the model is absent and every document gets an empty map.
    """
    key_type = docs.schema[key].dataType.simpleString()

    def tag(batches: Iterator) -> Iterator:
        try:
            tagger = load_tagger()
        except ImportError:
            tagger = None
        for batch in batches:
            values = batch[text]
            empty = values.isna() | (values.fillna("").str.strip() == "")
            batch["entities"] = [
                {} if tagger is None or skip else dict(tagger(value)) for value, skip in zip(values, empty)
            ]
            yield batch[[key, "entities"]]

    return docs.select(key, text).mapInPandas(tag, f"`{key}` {key_type}, entities map<string,int>")
