"""The thirteen operators over whole tables, with production parameters."""

from __future__ import annotations

import json
import os

import public_tokenizers
from pyspark.sql import functions as F

from . import chat
from .common import table, work_folder
from .decontamination import mark_documents
from .imatch import fingerprint_documents
from .infill import infill_documents
from .oracles import REPAIR
from .packing import pack_documents
from .quality import score_documents
from .registry import query
from .repair import repair_damaged
from .rules import judge_documents
from .sharding import shard_documents
from .simhash import near_components
from .suffixes import removed_summary
from .tokencounts import count_tokens, fill_cache
from .tokenfiles import read_token_files, write_token_files

#: Where the vocabulary files are, unless the package that brings them is to be asked.
TOKENIZERS = os.environ.get("LEDGERLAKE_TOKENIZERS", "")


def vocabulary(name: str) -> str:
    return os.path.join(TOKENIZERS, name) if TOKENIZERS else public_tokenizers.path(name)


@query()
def op1_best_fit_packing(spark, folder):
    packed = pack_documents(table(spark, folder, "documents"), vocabulary("byte_bpe_50k.json"), end_id=2, size=1024)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query()
def op2_sharding(spark, folder):
    return shard_documents(table(spark, folder, "documents"), shards=8)


@query()
def op3_token_files(spark, folder):
    place = work_folder(spark, "tokens")
    files = write_token_files(table(spark, folder, "documents"), vocabulary("word_bpe_49k.json"), 1, place)
    back = read_token_files(spark, place, files)
    n_tokens = (F.octet_length("ids") / 4).cast("long")
    return back.select("doc_id", "start", n_tokens.alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


@query()
def op4_suffix_dedup(spark, folder):
    return removed_summary(table(spark, folder, "documents"), length=100)


@query()
def op5_decontamination(spark, folder):
    return mark_documents(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query()
def op6_quality(spark, folder):
    return score_documents(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query()
def op7_token_counts(spark, folder):
    """All documents, against a cache that an earlier run over about half of the texts has filled."""
    docs, path, cache = table(spark, folder, "documents"), vocabulary("byte_bpe_50k.json"), work_folder(spark, "counts")
    fill_cache(docs.filter(F.xxhash64(F.coalesce("text", F.lit(""))) > 0), path, cache)
    return count_tokens(docs, path, cache, limit=512)


EXTRA_ID, EXTRA_TEXT = -7, "</s>[INST] ok [/INST]"


def _escaped(column: str) -> str:
    return f"replace(replace(replace({column}, '&', '&amp;'), '<', '&lt;'), '[', '&#91;')"


@query(f"""
WITH rows AS (
    SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT {EXTRA_ID}, 0, 'user', '{EXTRA_TEXT}' UNION ALL SELECT {EXTRA_ID}, 1, 'assistant', '{EXTRA_TEXT}')
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(length('{chat.START}') + length({_escaped("role")}) + 1 + length({_escaped("text")}) + 8)::BIGINT AS formatted_chars
FROM rows GROUP BY conv_id""")
def op8_chat_formatting(spark, folder):
    said = [{"role": role, "content": EXTRA_TEXT} for role in ("user", "assistant")]
    extra = spark.createDataFrame([(EXTRA_ID, json.dumps({"messages": said}))], chat.PAYLOADS)
    turns = chat.canonical(table(spark, folder, "conversations")).unionByName(chat.canonical(extra))
    return chat.summary(chat.format_turns(turns))


@query()
def op9_imatch(spark, folder):
    return fingerprint_documents(table(spark, folder, "documents"))


@query()
def op10_simhash(spark, folder):
    found = near_components(table(spark, folder, "documents"))
    fingerprint = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return found.select("doc_id", fingerprint.alias("fingerprint"), "component_id")


def _units(low: str, high: str) -> str:
    return f"array_to_string(units[{low} + 1:{high}], '')"


@query(f"""
WITH given AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
cut AS (
    SELECT doc_id, text, regexp_extract_all(text, '[^\n]*\n|[^\n]+') AS units,
        ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[25:32])::BIGINT AS h4
    FROM given),
placed AS (
    SELECT *, len(units) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a,
        greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') THEN 'plain'
             WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
    FROM cut),
parts AS (
    SELECT *, {_units("0", "a")} AS prefix, {_units("a", "b")} AS middle, {_units("b", "n")} AS suffix FROM placed)
SELECT doc_id, n::BIGINT AS n, form,
    CASE WHEN form <> 'plain' THEN length(prefix) END::BIGINT AS prefix_chars,
    CASE WHEN form <> 'plain' THEN length(middle) END::BIGINT AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
    sha256(text) AS restored_sha256
FROM parts""")
def op11_infill(spark, folder):
    return infill_documents(table(spark, folder, "documents"))


@query()
def op12_quality_rules(spark, folder):
    return judge_documents(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query(REPAIR)
def op13_conversation_repair(spark, folder):
    return repair_damaged(table(spark, folder, "conversations"))
