"""The library's functions for use in SQL."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

from bookloom.functions import keys as K
from bookloom.functions import text as T


class Lines:
    """Lines of a text with their numbers from 1."""

    def eval(self, text: str) -> Iterator[tuple[int, str]]:
        if text is not None:
            yield from enumerate(text.replace("\r\n", "\n").split("\n"), 1)


def _text(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def register(spark: SparkSession) -> list[str]:
    """Make the functions known to a session as temporary ones; returns their names.

    All but ``decomposed`` and the table function ``lines_of`` are SQL
    expressions, which run where the built-in functions run.
    """
    spark.udf.register("decomposed", K.decomposed)
    spark.udtf.register("lines_of", udtf(Lines, returnType="no int, line string"))
    squeezed = f"trim(regexp_replace(coalesce(t, ''), {_text(K.SPACE + '+')}, ' '))"
    made = {
        "squeezed(t STRING) RETURNS STRING": squeezed,
        "word_count(t STRING) RETURNS INT": r"regexp_count(t, '\\S+')",
        "token_estimate(t STRING) RETURNS BIGINT": "ceil(octet_length(t) / 4)",
        "decoding_signals(t STRING) RETURNS INT": f"regexp_count(t, {_text(T.SIGNALS)})",
        "quality_reasons(t STRING) RETURNS ARRAY<STRING>": rf"array_compact(array(if(octet_length(t) < {T.LEAST_BYTES}, 'too_small', null), if(regexp_count(t, '\\S+') < {T.LEAST_WORDS}, 'too_few_words', null)))",
        "stable_id(prefix STRING, t STRING) RETURNS STRING": "concat(prefix, '_', substring(sha1(t), 1, 16))",
        "payload_hash(t STRING) RETURNS STRING": rf"sha2(array_join(filter(split(t, '\\r?\\n'), x -> x rlike '\\S' AND NOT x rlike {_text(T.NO_PAYLOAD)}), '\n'), 256)",
    }
    for head, body in made.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
    return ["decomposed", "lines_of", *(h.split("(")[0] for h in made)]
