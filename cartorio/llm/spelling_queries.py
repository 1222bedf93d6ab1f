"""The registered query of the spelling variants, and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartorio.llm.spellings import variants

LEAST_LETTERS, LEAST_COUNT = 7, 2
#: One run in so many loses a letter.
LOSES = 31
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of all documents, some with a letter lost, each with the word it is a variant of."""
    return variants(damaged_words(spark.read.parquet(f"{sf_dir}/documents.parquet")))


def damaged_words(docs: DataFrame) -> DataFrame:
    """``word`` and ``n``. A shorter run can't become a word, so it isn't read; a null id counts as empty."""
    run = F.explode(F.regexp_extract_all(
        "text", F.lit(f"([A-Za-zÀ-ÿ]{{{LEAST_LETTERS},}})"), F.lit(1)
    ))
    runs = docs.select("doc_id", run.alias("run")).select(
        F.translate("run", _UPPER, _LOWER).alias("run"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id")
    ).withColumn("h", F.crc32(F.concat_ws(":", "id", "run")))
    run, at = F.col("run"), (F.col("h") % F.length("run")).cast("int")
    lost = F.concat(run.substr(F.lit(1), at), run.substr(at + 2, F.length("run")))
    words = runs.select(F.when(F.col("h") % LOSES == 0, lost).otherwise(run).alias("word"))
    return (
        words.filter(F.length("word") >= LEAST_LETTERS)
        .groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= LEAST_COUNT)
    )


SQL = {
    "op11_spelling_variants": f"""
        WITH RECURSIVE steps AS (
            SELECT i, 0 AS k, i AS v FROM range(256) t(i)
            UNION ALL
            SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END
            FROM steps WHERE k < 8
        ), crc AS (
            SELECT list(v ORDER BY i) AS t FROM steps WHERE k = 8
        ), runs AS (
            SELECT d, translate(r, '{_UPPER}', '{_LOWER}') AS r, count(*) AS c
            FROM (SELECT coalesce(doc_id::VARCHAR, '') AS d,
                  unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')) AS r FROM documents)
            WHERE length(r) >= {LEAST_LETTERS} GROUP BY ALL
        ), bytes AS (
            SELECT d, r, c, hex(encode(d || ':' || r)) AS x FROM runs
        ), hashed AS (
            SELECT r, c, xor(4294967295, list_reduce(
                list_prepend(4294967295, list_transform(range(0, length(x) // 2),
                    lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT)),
                lambda p, b: xor(p >> 8, t[(xor(p, b) & 255) + 1]))) AS h
            FROM bytes, crc
        ), words AS (
            SELECT CASE WHEN h % {LOSES} = 0 THEN r[1 : h % length(r)] || r[h % length(r) + 2 :] ELSE r END AS word,
                sum(c)::BIGINT AS n
            FROM hashed GROUP BY 1 HAVING length(word) >= {LEAST_LETTERS} AND sum(c) >= {LEAST_COUNT}
        ), gaps AS (
            SELECT DISTINCT word, n, length(word) AS size, i, word[1 : i] || word[i + 2 :] AS gap
            FROM (SELECT word, n, unnest(range(0, length(word))) AS i FROM words)
        ), pairs AS (
            SELECT a.word, b.word AS other, b.n FROM gaps a JOIN gaps b USING (gap, i, size) WHERE a.word <> b.word
            UNION SELECT g.word, w.word, w.n FROM gaps g JOIN words w ON g.gap = w.word
            UNION SELECT w.word, g.word, g.n FROM gaps g JOIN words w ON g.gap = w.word
        ), near AS (
            SELECT word, count(*) AS n_near FROM pairs GROUP BY word
        ), best AS (
            SELECT word, other, n AS other_n FROM pairs
            QUALIFY row_number() OVER (PARTITION BY word ORDER BY n DESC, other) = 1
        ), forms AS (
            SELECT word, other AS form, other_n AS form_n FROM best JOIN words USING (word) WHERE other_n >= 10 * n
        ), chain AS (
            SELECT word, word AS root FROM words
            UNION SELECT chain.word, forms.form FROM chain JOIN forms ON forms.word = chain.root
        ), roots AS (
            SELECT word, root FROM chain WHERE root NOT IN (SELECT word FROM forms)
        )
        SELECT word, n, coalesce(n_near, 0) AS n_near, form, form_n, root
        FROM words LEFT JOIN near USING (word) LEFT JOIN forms USING (word) JOIN roots USING (word)""",
}
