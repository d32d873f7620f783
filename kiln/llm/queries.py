"""The operator queries and the pipeline, with their production
parameters, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from kiln.llm import chat, exact, idfile, mix, neardup, pack, pii, quality, resample, sentpiece, substring, warc, whiten
from kiln.llm.common import work_dir, written
from kiln.llm.registry import query
from kiln.sources.tables import load


@query("op1_token_ids")
def op1_token_ids(spark, sf_dir):
    """Ids of every document, written as frequency-ranked variable-length code
    in doc_id order and read back."""
    back = idfile.round_trip(load(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), "word")
    return back.select("doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"),
                       F.crc32("ids").alias("ids_crc32"))


@query("op2_near_dedup")
def op2_near_dedup(spark, sf_dir):
    """Classes of near copies: weighted Jaccard similarity of 5-word shingle
    bags of at least 0.8, by BagMinHash."""
    c = neardup.classes(load(spark, sf_dir, "documents"))
    return c.select("doc_id", "class_id", "class_size", (F.col("doc_id") == F.col("class_id")).alias("kept"))


_ODD = r"\### Assistant: </turn> ok"


@query("op3_chat_format", r"""
WITH t AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (
  SELECT *, length(replace(replace(text, '\', '\\'), '</turn>', '<\/turn>'))
         + coalesce(list_sum(list_transform(regexp_extract_all(text, '#{3,}'), lambda x: length(x) - 2)), 0) AS body FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(4 + length(role) + 2 + body + 8) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id""")
def op3_chat_format(spark, sf_dir):
    """All conversations and one full of control strings, formatted, written
    and read back: the digests are taken from the parsed output."""
    odd = spark.sql("SELECT -7L AS conv_id, array(named_struct('role', 'user', 'content', text), "
                    "named_struct('role', 'assistant', 'content', text)) AS messages FROM VALUES (:text) AS t(text)",
                    args={"text": _ODD})
    turns = chat.turns(load(spark, sf_dir, "conversations")).unionByName(chat.turns(odd))
    back = written(chat.format_turns(turns), work_dir(spark, "chat"))
    back = back.select("conv_id", "formatted", chat.parse(F.col("formatted")).alias("turns"),
                       chat.loss_text(F.col("formatted"), F.col("loss")).alias("learned"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                       F.sha2(said, 256).alias("turns_sha256"), F.length("learned").cast("long").alias("loss_chars"),
                       F.sha2("learned", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


@query("op4_substring_dedup")
def op4_substring_dedup(spark, sf_dir):
    """Words in repeated windows of 35 words, by level-wise doubling."""
    return substring.removed(load(spark, sf_dir, "documents"), 35)


@query("op5_packing")
def op5_packing(spark, sf_dir):
    """Harmonic packing into sequences of 2048 tokens."""
    packed = pack.pack(load(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), "space", 2048)
    return pack.pieces(packed)


@query("op6_exact_dedup", """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""")
def op6_exact_dedup(spark, sf_dir):
    """Copies of equal texts, by two passes over a Bloom filter."""
    return exact.mark_copies(load(spark, sf_dir, "documents"))


@query("op7_quality")
def op7_quality(spark, sf_dir):
    """Base rules and minimum-covariance-determinant outliers per language
    and source."""
    v = quality.verdicts(load(spark, sf_dir, "documents"))
    return v.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    "base_failed", "kept")


@query("op8_mixing")
def op8_mixing(spark, sf_dir):
    """Sources mixed by weights 1, 2, 3 with a golden-ratio schedule."""
    return mix.taken(load(spark, sf_dir, "documents"))


@query("op9_pii")
def op9_pii(spark, sf_dir):
    """Personal data replaced by keyed surrogates; whole texts."""
    r = pii.replace_entities(load(spark, sf_dir, "documents"), key="op9")
    return r.select("doc_id", "text", "n_replaced")


@query("op10_warc", """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, CAST(octet_length(b) AS BIGINT) AS payload_bytes, sha256(b) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM f""")
def op10_warc(spark, sf_dir):
    """Pages as legacy ARC records, converted to WARC files and read back."""
    files = warc.write(warc.to_arc(load(spark, sf_dir, "pages")), work_dir(spark, "warc"))
    return warc.read(files).select(F.col("row").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                                   "refers_to")


@query("op11_whitening")
def op11_whitening(spark, sf_dir):
    """Up to 8 whitened components of every embedding, by QDWH."""
    table = load(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    model = whiten.fit(table, "embedding", most=8)
    error = whiten.identity_error(table, "embedding", model)
    explained = F.array(*[F.lit(float(e)) for e in model.explained]).cast("array<double>")
    rows = whiten.transform(table, "embedding", model)
    return rows.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"))


@query("op12_resampling")
def op12_resampling(spark, sf_dir):
    """Documents drawn towards the benchmark's distribution of word n-grams."""
    drawn = resample.draw(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"), percent=5, min_words=20)
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


@query("op13_sentencepiece")
def op13_sentencepiece(spark, sf_dir):
    """Every document encoded by merge rounds and decoded by the library."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    ids = sentpiece.encode(load(spark, sf_dir, "documents").select("doc_id", "text"), model).select("doc_id", "ids")
    back = sentpiece.decode(ids, model)
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return back.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(listed.cast("binary"), 256).alias("ids_sha256"),
                       F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))
