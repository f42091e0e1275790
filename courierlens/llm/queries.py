"""The operators over their whole tables, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from courierlens.llm.digest import fingerprint_documents
from courierlens.llm.grammar import encode_documents
from courierlens.llm.graph import link_vectors
from courierlens.llm.langid import learn_languages, predict_languages
from courierlens.llm.mixing import Mix, mix_documents, mix_sql
from courierlens.llm.packing import pack_documents
from courierlens.llm.prefixtrie import prefix_trie, trie_sql
from courierlens.llm.setjoin import link_documents
from courierlens.llm.sharding import shard_documents, shard_sql
from courierlens.llm.toxicity import learn_toxicity, score_toxicity
from courierlens.llm.urls import Rule, judge_sql, judge_urls
from courierlens.llm.vectorcodes import code_vectors, codes_sql
from courierlens.llm.wordpiece import byte_pieces, count_tokens

Query = Callable[[SparkSession, str], DataFrame]

URL_RULES = [
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
]

# three domains by source; languages and sources of a domain weigh alike but for those listed
MIX = Mix(
    domains={f"src{i}": "web" if i < 10 else "books" if i < 15 else "reference" for i in range(20)},
    weights={
        ("web",): 5,
        ("books",): 3,
        ("reference",): 2,
        ("web", "en"): 4,
        ("books", "en"): 3,
        ("web", "en", "src0"): 2,
    },
)


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def vocabulary_file() -> str:
    """The public byte-level vocabulary; it is read where it is installed, never copied."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_language_id(spark: SparkSession, root: str) -> DataFrame:
    docs = table(spark, root, "documents")
    return predict_languages(docs, learn_languages(docs))


def op2_shingle_join(spark: SparkSession, root: str) -> DataFrame:
    return link_documents(table(spark, root, "documents"))


def op3_token_files(spark: SparkSession, root: str) -> DataFrame:
    return encode_documents(table(spark, root, "documents"), vocabulary_file())


def op4_toxicity(spark: SparkSession, root: str) -> DataFrame:
    docs = table(spark, root, "documents")
    return score_toxicity(docs, learn_toxicity(docs, table(spark, root, "labels")))


def op5_mixing(spark: SparkSession, root: str) -> DataFrame:
    return mix_documents(table(spark, root, "documents"), MIX)


def op6_fingerprints(spark: SparkSession, root: str) -> DataFrame:
    return fingerprint_documents(table(spark, root, "documents"))


def op7_packing(spark: SparkSession, root: str) -> DataFrame:
    return pack_documents(table(spark, root, "documents"), vocabulary_file())


def op8_near_vectors(spark: SparkSession, root: str) -> DataFrame:
    return link_vectors(table(spark, root, "embeddings"))


def op9_token_counts(spark: SparkSession, root: str) -> DataFrame:
    return count_tokens(table(spark, root, "documents"), byte_pieces(vocabulary_file()))


def op10_url_filter(spark: SparkSession, root: str) -> DataFrame:
    return judge_urls(table(spark, root, "pages"), URL_RULES)


def op11_prefix_trie(spark: SparkSession, root: str) -> DataFrame:
    return prefix_trie(table(spark, root, "conversations"))


def op12_vector_codes(spark: SparkSession, root: str) -> DataFrame:
    return code_vectors(table(spark, root, "embeddings"))


def op13_sharding(spark: SparkSession, root: str) -> DataFrame:
    return shard_documents(table(spark, root, "documents"))


LLM_QUERIES: dict[str, Query] = {
    "op1_language_id": op1_language_id,
    "op2_shingle_join": op2_shingle_join,
    "op3_token_files": op3_token_files,
    "op4_toxicity": op4_toxicity,
    "op5_mixing": op5_mixing,
    "op6_fingerprints": op6_fingerprints,
    "op7_packing": op7_packing,
    "op8_near_vectors": op8_near_vectors,
    "op9_token_counts": op9_token_counts,
    "op10_url_filter": op10_url_filter,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_vector_codes": op12_vector_codes,
    "op13_sharding": op13_sharding,
}

LLM_EQUIVALENTS: dict[str, str] = {
    "op5_mixing": mix_sql(MIX),
    "op10_url_filter": judge_sql(URL_RULES),
    "op11_prefix_trie": trie_sql(),
    "op12_vector_codes": codes_sql(),
    "op13_sharding": shard_sql(),
}
