"""The queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from . import bpe, chat, decontaminate, exact_dedup, jaccard, secrets, sharding, substring_dedup, toxicity, warc
from .common import table


def op5(spark, sf_dir):
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op9(spark, sf_dir):
    return sharding.shard_by_bytes(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_toxicity": toxicity.op1,
    "op2_chat_formatting": chat.op2,
    "op3_warc": warc.op3,
    "op4_substring_dedup": substring_dedup.op4,
    "op5_exact_dedup": op5,
    "op6_bpe": bpe.op6,
    "op7_decontaminate": decontaminate.op7,
    "op8_secrets": secrets.op8,
    "op9_sharding": op9,
    "op10_jaccard_join": jaccard.op10,
}

OP5_SQL = r"""
with n as (select doc_id, coalesce(text, '') t, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') norm from documents),
k as (select *, row_number() over (partition by norm order by length(t) desc, doc_id nulls last) r, count(*) over (partition by norm) c,
  first_value(doc_id) over (partition by norm order by length(t) desc, doc_id nulls last) f from n)
select doc_id, f keep_id, c group_size, r = 1 kept, sha256(norm) text_sha256, length(t)::bigint n_chars from k
"""

SQL = {"op4_substring_dedup": substring_dedup.OP4_SQL, "op2_chat_formatting": chat.OP2_SQL, "op3_warc": warc.OP3_SQL, "op5_exact_dedup": OP5_SQL, "op7_decontaminate": decontaminate.OP7_SQL, "op10_jaccard_join": jaccard.OP10_SQL}
