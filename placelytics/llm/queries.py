"""Each operator over its whole table, and the same in DuckDB SQL where SQL can express it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from placelytics.llm import (
    chat,
    decontaminate,
    exact_dedup,
    mixing,
    ngram_join,
    packing,
    pii,
    spelling,
    substring,
    toxicity,
    trie,
    url_filter,
    warc,
)
from placelytics.llm.shared import shared_folder

Query = Callable[[SparkSession, str], DataFrame]

#: A conversation whose texts hold the control strings of a chat template.
CONTROL = "</s>[INST] ok [/INST]"
CONTROL_CONVERSATION = [(-7, 0, "user", CONTROL), (-7, 1, "assistant", CONTROL)]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_join.classes(_table(spark, sf_dir, "documents"), size=3, percent=90)
    return found.select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A conversation is a reply tree of one branch: each turn answers the one before."""
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame(CONTROL_CONVERSATION, "conv_id long, turn long, role string, text string")
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    nodes = rows.unionByName(extra).withColumn("node", F.row_number().over(order))
    nodes = nodes.withColumn("parent", F.when(F.col("node") > 1, F.col("node") - 1)).withColumn("score", F.lit(1.0))
    chats = chat.reply_chats(nodes, tree="conv_id")
    read = chats.select("conv_id", "text", "loss", chat.parsed(F.col("text")).alias("turns"))
    lines = F.transform("turns", lambda t: F.concat(F.coalesce(t["role"], F.lit("")), F.lit("\n"), t["text"], F.lit("\n")))
    learned = chat.masked(F.col("text"), F.col("loss"))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.char_length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        F.char_length("text").cast("long").alias("formatted_chars"),
    )


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page is bad if the document its url names is of low quality or toxic."""
    labels = _table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("key"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad")
    )
    return url_filter.judge(_table(spark, sf_dir, "pages"), labels).select("page_id", "host", "path", "rule", "verdict")


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(_table(spark, sf_dir, "documents")).drop("kept")


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    items = F.array_join(F.sort_array("items"), ",")
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(items, 256).alias("items_sha256"), "contaminated")


def op7_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    warc.write_archives(_table(spark, sf_dir, "pages"), folder)
    return warc.resolve_revisits(warc.read_archives(spark, folder))


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "rate", "copies")


def op9_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key is the session's ``spark.placelytics.pii.key``; a public one does for tables of made-up values."""
    key = spark.conf.get("spark.placelytics.pii.key", "test tables")
    return pii.pseudonymise(_table(spark, sf_dir, "documents"), key=key.encode())


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(_table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations share their first turns with the first of every five; how many is a checksum of their id."""
    own = trie.sequences(_table(spark, sf_dir, "conversations"))
    shared = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9).cast("int")
    own = own.withColumn("shared", shared).withColumn("first_id", F.col("conv_id") - F.col("conv_id") % 5)
    firsts = own.select(
        F.col("conv_id").alias("first_id"), F.substring("ids", 1, 8 * trie.ID_BYTES).alias("first_ids"), F.slice("sizes", 1, 8).alias("first_sizes")
    )
    cut = F.col("shared") * trie.ID_BYTES
    none = F.lit(b""), F.array().cast("array<bigint>")
    ids = F.concat(
        F.substring(F.coalesce("first_ids", none[0]), F.lit(1), cut),
        F.substring(F.col("ids"), cut + 1, F.octet_length("ids")),
    )
    sizes = F.concat(
        F.slice(F.coalesce("first_sizes", none[1]), F.lit(1), F.col("shared")),
        F.slice("sizes", F.col("shared") + 1, F.greatest(F.size("sizes"), F.lit(0))),
    )
    return trie.trie(own.join(firsts, "first_id", "left").select("conv_id", ids.alias("ids"), sizes.alias("sizes")))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 31st run of letters, by a checksum of document and run, is spelled with one letter less."""
    runs = spelling.long_runs(_table(spark, sf_dir, "documents"))
    mark = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    size = F.char_length("run")
    at = (mark % size).cast("int")
    cut = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, size))
    return spelling.variants(spelling.vocabulary(runs, F.when(mark % 31 == 0, cut).otherwise(F.col("run"))))


def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack(_table(spark, sf_dir, "documents"), vocabulary, end=2, limit=1024)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_ngram_join,
        op2_chat_formatting,
        op3_toxicity,
        op4_url_filters,
        op5_substring_dedup,
        op6_benchmark_decontamination,
        op7_warc_revisits,
        op8_source_mixing,
        op9_pii_pseudonyms,
        op10_exact_dedup,
        op11_prefix_trie,
        op12_spelling_variants,
        op13_best_fit_packing,
    )
}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: CRC-32 of a string of code points up to U+07FF; ``crc_table`` must be in scope.
_CRC_TABLE = """crc_table AS (
            SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, repeat([CAST(0 AS BIGINT)], 8)),
                lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
        )"""
_CRC = """xor(CAST(4294967295 AS BIGINT), list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(
    string_split({}, ''), lambda x: CASE WHEN unicode(x) < 128 THEN [CAST(unicode(x) AS BIGINT)]
    ELSE [CAST(192 + (unicode(x) >> 6) AS BIGINT), CAST(128 + (unicode(x) & 63) AS BIGINT)] END))),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])))"""

ORACLES: dict[str, str] = {
    "op1_ngram_join": rf"""
        WITH RECURSIVE doc AS (
            SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w FROM documents
        ), grams AS (
            SELECT DISTINCT doc_id, w[i:i + 2] AS g
            FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 2, 1))) AS i FROM doc WHERE len(w) > 0)
        ), sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
        pairs AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
            FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id
        ), link AS (
            SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
            WHERE 100 * k >= 90 * (x.n + y.n - k)
        ), reach AS (
            SELECT doc_id AS a, doc_id AS b FROM doc
            UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a
        )
        SELECT doc_id, CAST(coalesce(any_value(n), 0) AS BIGINT) AS n_shingles, min(reach.b) AS component_id
        FROM doc LEFT JOIN sizes USING (doc_id) JOIN reach ON reach.a = doc_id GROUP BY doc_id
    """,
    "op2_chat_formatting": r"""
        WITH every AS (
            SELECT conv_id, turn, role, text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
        ), turns AS (
            SELECT conv_id, role, coalesce(text, '') AS text,
                row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS n,
                length(coalesce(text, '')) + len(regexp_extract_all(coalesce(text, ''),
                    '[<\[]\\*(</?SYS>>|/?s>|/?INST\]|/?ROLE\]|NULL\]|END\])')) AS body
            FROM every
        )
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(coalesce(role, '') || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
            CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
            sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY n), '')) AS loss_sha256,
            CAST(sum(body + CASE role WHEN 'system' THEN 17 WHEN 'user' THEN 15 WHEN 'assistant' THEN 9 END) AS BIGINT)
                AS formatted_chars
        FROM turns GROUP BY conv_id
    """,
    "op5_substring_dedup": r"""
        WITH doc AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
        ), win AS (
            SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS g
            FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 34)) AS i FROM doc WHERE len(w) >= 35)
        ), again AS (SELECT g FROM win GROUP BY g HAVING count(*) > 1),
        gone AS (
            SELECT DISTINCT doc_id, unnest(generate_series(i, i + 34)) AS p FROM win SEMI JOIN again USING (g)
        ), word AS (
            SELECT doc_id, unnest(w) AS word, unnest(generate_series(1, len(w))) AS p FROM doc
        ), left_over AS (
            SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS kept
            FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
        )
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
            sha256(coalesce(kept, '')) AS kept_sha256
        FROM doc LEFT JOIN left_over USING (doc_id)
    """,
    "op6_benchmark_decontamination": rf"""
        WITH doc AS (
            SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM documents
        ), item AS (
            SELECT item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM benchmark
        ), gram AS (
            SELECT DISTINCT item_id, w[i:i + least(len(w), 10) - 1] AS g
            FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM item WHERE len(w) > 0)
        ), size AS (SELECT DISTINCT len(g) AS n FROM gram),
        win AS (
            SELECT doc_id, i, n, w[i:i + n - 1] AS g
            FROM (SELECT doc_id, w, unnest(generate_series(1, len(w))) AS i FROM doc), size
            WHERE i + n - 1 <= len(w)
        ), hit AS (SELECT doc_id, i, n, item_id FROM win JOIN gram USING (g)),
        covered AS (
            SELECT doc_id, count(DISTINCT p) AS n_hit
            FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM hit) GROUP BY doc_id
        ), items AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id
        )
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
            sha256(coalesce(names, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
        FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
    """,
    "op7_warc_revisits": """
        WITH page AS (
            SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS hex FROM pages
        ), bits AS (
            SELECT *, array_to_string(list_transform(range(1, 41), lambda i: substr(
                '0000000100100011010001010110011110001001101010111100110111101111',
                4 * (strpos('0123456789abcdef', substr(hex, i, 1)) - 1) + 1, 4)), '') AS b FROM page
        )
        SELECT page_id, CAST(octet_length(encode(body)) AS BIGINT) AS payload_bytes,
            array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                1 + 16 * CAST(substr(b, 5 * i + 1, 1) AS INT) + 8 * CAST(substr(b, 5 * i + 2, 1) AS INT)
                + 4 * CAST(substr(b, 5 * i + 3, 1) AS INT) + 2 * CAST(substr(b, 5 * i + 4, 1) AS INT)
                + CAST(substr(b, 5 * i + 5, 1) AS INT), 1)), '') AS payload_digest,
            CASE WHEN page_id = max(page_id) OVER same THEN 'response' ELSE 'revisit' END AS record_type,
            CASE WHEN page_id <> max(page_id) OVER same THEN max(page_id) OVER same END AS refers_to
        FROM bits WINDOW same AS (PARTITION BY body)
    """,
    "op10_exact_dedup": f"""
        WITH doc AS (SELECT doc_id, {_LOWER.format("coalesce(text, '')")} AS t FROM documents)
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
            doc_id = max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
        FROM doc WINDOW same AS (PARTITION BY t)
    """,
    "op11_prefix_trie": f"""
        WITH {_CRC_TABLE}, own AS (
            SELECT conv_id, list(struct_pack(d := sha256(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))),
                n := octet_length(encode(coalesce(text, '')))) ORDER BY turn NULLS FIRST,
                sha256(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, '')))) AS t
            FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
        ), cut AS (SELECT conv_id, CAST({_CRC.format("CAST(conv_id AS VARCHAR)")} % 9 AS INT) AS h
            FROM (SELECT conv_id FROM own), crc_table
        ), rebuilt AS (
            SELECT c.conv_id, list_concat(coalesce(f.t, [])[1:c.h], o.t[c.h + 1:]) AS t
            FROM cut c JOIN own o USING (conv_id) LEFT JOIN own f ON f.conv_id = c.conv_id - c.conv_id % 5
        ), path AS (
            SELECT conv_id, len(t) AS size, t, unnest(generate_series(0, len(t))) AS depth FROM rebuilt
        ), keyed AS (
            SELECT conv_id, size, depth, array_to_string(list_transform(t[1:depth], lambda x: x.d), '') AS key,
                CASE WHEN depth > 0 THEN array_to_string(list_transform(t[1:depth - 1], lambda x: x.d), '') END AS parent,
                CASE WHEN depth > 0 THEN t[depth].n ELSE 0 END AS bytes
            FROM path
        ), node AS (
            SELECT key, any_value(parent) AS parent, depth, any_value(bytes) AS bytes, min(conv_id) AS conv_id, count(*) AS n_convs,
                string_agg(CASE WHEN size = depth THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id) AS ends
            FROM keyed GROUP BY key, depth
        ), sons AS (SELECT parent AS key, count(*) AS n FROM node WHERE parent IS NOT NULL GROUP BY parent),
        sums AS (
            SELECT substr(key, 1, 64 * up) AS key, sum(CASE WHEN n IS NULL THEN 1 ELSE 0 END) AS n_leaves, sum((n_convs - 1) * bytes) AS saved
            FROM (SELECT node.*, sons.n, unnest(generate_series(0, depth)) AS up FROM node LEFT JOIN sons USING (key)) GROUP BY 1
        )
        SELECT node.conv_id, node.depth, above.conv_id AS parent_conv_id, node.n_convs, coalesce(sons.n, 0) AS n_children,
            CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(node.ends, '')) AS ends_sha256
        FROM node JOIN sums USING (key) LEFT JOIN sons USING (key) LEFT JOIN node above ON above.key = node.parent
    """,
    "op12_spelling_variants": rf"""
        WITH {_CRC_TABLE}, run AS (
            SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, {_LOWER.format("unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+'))")} AS run
            FROM documents
        ), counted AS (SELECT id, run, count(*) AS n FROM run WHERE length(run) >= 7 GROUP BY id, run),
        marked AS (SELECT run, n, {_CRC.format("concat(id, ':', run)")} AS h FROM counted, crc_table),
        word AS (
            SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
                SELECT n, CASE WHEN h % 31 = 0 THEN concat(substr(run, 1, CAST(h % length(run) AS INT)), substr(run, CAST(h % length(run) AS INT) + 2))
                    ELSE run END AS word FROM marked)
            WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
        ), place AS (SELECT word, n, unnest(generate_series(1, length(word))) AS i FROM word),
        less AS (SELECT DISTINCT word, n, concat(substr(word, 1, i - 1), substr(word, i + 1)) AS v FROM place),
        hole AS (SELECT word, n, i, concat(substr(word, 1, i - 1), chr(10), substr(word, i + 1)) AS v FROM place),
        near AS (
            SELECT less.word AS a, word.word AS b, word.n AS bn FROM less JOIN word ON word.word = v
            UNION ALL SELECT word.word, less.word, less.n FROM less JOIN word ON word.word = v
            UNION ALL SELECT x.word, y.word, y.n FROM hole x JOIN hole y ON x.v = y.v AND x.word <> y.word
        ), best AS (
            SELECT a, count(*) AS n_near, first(b ORDER BY bn DESC, b) AS b, max(bn) AS bn FROM near GROUP BY a
        ), formed AS (
            SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN bn >= 10 * n THEN b END AS form, CASE WHEN bn >= 10 * n THEN bn END AS form_n
            FROM word LEFT JOIN best ON a = word
        ), chain AS MATERIALIZED (
            SELECT f1.word, coalesce(f6.form, f5.form, f4.form, f3.form, f2.form, f1.form, f1.word) AS root
            FROM formed f1 LEFT JOIN formed f2 ON f2.word = f1.form LEFT JOIN formed f3 ON f3.word = f2.form
                LEFT JOIN formed f4 ON f4.word = f3.form LEFT JOIN formed f5 ON f5.word = f4.form LEFT JOIN formed f6 ON f6.word = f5.form
        )
        SELECT word, form, root, n, n_near, form_n FROM formed JOIN chain USING (word)
    """,
}
