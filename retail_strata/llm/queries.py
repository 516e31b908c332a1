"""One query per operator, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_strata.llm import (
    ann_tree,
    bitpack,
    bpe,
    decontaminate,
    html_text,
    license_templates,
    partenum,
    prefix_trie,
    substring_dedup,
    tokenizer_alignment,
    toxicity,
    warc,
)
from retail_strata.llm.common import read_table, ship, stage
from retail_strata.llm.license_texts import BASE_PHRASES, TEMPLATES
from retail_strata.llm.token_rollup import TokenRollup
from retail_strata.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
TOKENIZER = "word_bpe_49k.json"
BYTE_TOKENIZER, PIECE_TOKENIZER = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Id that op10 appends to every document.
END_ID = 2
#: Time that op4's responses are dated, as the pages have none.
FETCHED = "2025-01-01T00:00:00Z"


def query(function: Query) -> Query:
    @wraps(function)
    def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = shipped
    return shipped


@query
def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(
        read_table(spark, sf_dir, "documents"),
        "doc_id",
        "text",
        read_table(spark, sf_dir, "benchmark"),
        "item_id",
        "text",
    )


@query
def op2_token_count_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load two tokenizers' counts, revise one, delete rows of low quality, repeat a batch."""
    documents = read_table(spark, sf_dir, "documents")
    low = read_table(spark, sf_dir, "labels").where("quality = 0").select("doc_id").distinct()

    def changes(op: str, rows: DataFrame, tokenizer: str, pattern: str | None) -> DataFrame:
        count = F.lit(None) if pattern is None else F.regexp_count("text", F.lit(pattern))
        return rows.select(
            F.lit(op).alias("op"),
            F.lit(0).cast("bigint").alias("seq"),
            "doc_id",
            "source",
            "lang",
            F.lit(tokenizer).alias("tokenizer"),
            count.cast("bigint").alias("n_tokens"),
        )

    rollup = TokenRollup(spark, scratch_path(spark, "llm-token-rollup"))
    load = changes("insert", documents, "words-1", r"[^ \t\n\x0b\f\r]+").unionByName(
        changes("insert", documents, "pieces-2", r"[A-Za-z]+|[0-9]|[^ \t\n\x0b\f\rA-Za-z0-9]")
    )
    english = documents.where("lang = 'en'")
    revised = changes("revise", english, "words-1", r"[^ \t\n\x0b\f\r]*[A-Za-z][^ \t\n\x0b\f\r]*")
    gone = documents.join(low, "doc_id", "left_semi")
    removed = changes("delete", gone, "words-1", None).unionByName(
        changes("delete", gone, "pieces-2", None)
    )
    rollup.apply("load", load)
    rollup.apply("revise", revised)
    rollup.apply("remove", removed)
    rollup.apply("revise", revised)  # comes again, and changes nothing
    return rollup.totals()


@query
def op3_bpe_tree_concatenation(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    return bpe.digests(documents, "doc_id", "text", public_tokenizers.path(TOKENIZER))


@query
def op4_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    responses = warc.responses_of_pages(read_table(spark, sf_dir, "pages"), FETCHED)
    records = warc.build_derivatives(
        responses, "page_id", "record_id", "target_uri", "warc_date", "http_head", "payload"
    )
    path = scratch_path(spark, "llm-warc")
    return warc.written_and_read(stage(records, "warc-records"), path)


@query
def op5_ann_kmeans_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = read_table(spark, sf_dir, "embeddings")
    return ann_tree.nearest(embeddings, "vec_id", "embedding", lambda vec_id: vec_id % 20 == 0)


@query
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    repeats = substring_dedup.find_repeats(read_table(spark, sf_dir, "documents"), "doc_id", "text")
    return repeats.drop("text_key")


@query
def op7_html_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(read_table(spark, sf_dir, "pages"), "page_id", "url", "html")


@query
def op8_ngram_jaccard_partenum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partenum.jaccard_components(read_table(spark, sf_dir, "documents"), "doc_id", "text")


@query
def op9_toxicity_noisy_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    labels = read_table(spark, sf_dir, "labels")
    scorer = toxicity.train(documents, "doc_id", "text", labels, "doc_id", "toxic")
    return toxicity.score(documents, "doc_id", "text", scorer)


@query
def op10_token_bit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = bitpack.pack_documents(
        read_table(spark, sf_dir, "documents"),
        "doc_id",
        "text",
        public_tokenizers.path(TOKENIZER),
        scratch_path(spark, "llm-packed-ids"),
        END_ID,
    )
    return bitpack.read_documents(shards, "doc_id")


@query
def op11_license_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_templates.scan_licenses(
        read_table(spark, sf_dir, "documents"), "doc_id", "text"
    ).drop("templates")


@query
def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenizer_alignment.alignment(
        read_table(spark, sf_dir, "documents"),
        "doc_id",
        "text",
        public_tokenizers.path(BYTE_TOKENIZER),
        public_tokenizers.path(PIECE_TOKENIZER),
    )


@query
def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = read_table(spark, sf_dir, "conversations")
    turns = prefix_trie.number_turns(conversations, "conv_id", "turn", "role", "text")
    heads = F.crc32(F.col("conv").cast("string").cast("binary")) % 4
    return prefix_trie.build_trie(*prefix_trie.graft(turns, 20, 3, heads))


# A unit is a stretch up to and with its sentence marks and line breaks, as in the operator. Repeated
# units of 20 words together are a passage; so are whole lines of fewer words that are repeats.
_UNITS = r"""
    units as (
        select doc_id, text,
            unnest(regexp_extract_all(text, '[^\n.!?]+[.!?]*\n*|[.!?]+\n*|\n+')) as raw,
            generate_subscripts(regexp_extract_all(text, '[^\n.!?]+[.!?]*\n*|[.!?]+\n*|\n+'), 1) as place
        from documents where text is not null
    ),
    placed as (
        select *, sum(length(raw)) over (partition by doc_id order by place) as stop,
            coalesce(sum(length(raw) - length(replace(raw, chr(10), ''))) over (
                partition by doc_id order by place rows between unbounded preceding and 1 preceding), 0) as line,
            trim(regexp_replace(lower(raw), '\s+', ' ', 'g')) as unit
        from units
    ),
    worded as (
        select doc_id, text, unit, line, stop, stop - length(raw) as start,
            len(string_split(unit, ' ')) as words,
            row_number() over (partition by doc_id order by place) as n
        from placed where unit <> ''
    ),
    ranked as (
        select *, min(doc_id) over (partition by unit) as kept_id,
            row_number() over (partition by unit order by doc_id, n) as occurrence
        from worded
    ),
    repeats as (
        select *, n - row_number() over (partition by doc_id order by n) as run
        from ranked where occurrence > 1
    ),
    passages as (
        select doc_id, min(start) as start, max(stop) as stop, count(*) as units,
            sum(words) as words, arg_min(kept_id, n) as kept_id
        from repeats group by doc_id, run having sum(words) >= 20
    ),
    short_lines as (
        select doc_id, min(n) as n, count(*) as units, min(start) as start, max(stop) as stop,
            sum(words) as words, trim(regexp_replace(lower(substr(any_value(text),
                cast(min(start) + 1 as bigint), cast(max(stop) - min(start) as bigint))), '\s+', ' ', 'g')) as unit
        from worded group by doc_id, line having sum(words) < 20
    ),
    ranked_lines as (
        select *, min(doc_id) over (partition by unit) as kept_id,
            row_number() over (partition by unit order by doc_id, n) as occurrence
        from short_lines
    ),
    repeated_lines as (
        select *, n - coalesce(sum(units) over (partition by doc_id order by n
            rows between unbounded preceding and 1 preceding), 0) as run
        from ranked_lines l where occurrence > 1 and not exists (
            from passages p where p.doc_id = l.doc_id and p.start <= l.start and l.start < p.stop)
    ),
    cut as (
        select * from passages
        union all
        select doc_id, min(start), max(stop), sum(units), sum(words), arg_min(kept_id, n)
        from repeated_lines group by doc_id, run
    )
"""


def _template_pattern(parts: tuple) -> str:
    """A template as a pattern over words that stand between two spaces each."""
    found = ""
    for part in parts:
        if isinstance(part, license_templates.Word):
            found += f" {part.text} "
        elif isinstance(part, license_templates.Optional):
            found += f"(?:{_template_pattern(part.parts)})?"
        else:
            given = "[^ ]+" if part.match is None else "|".join(sorted(part.match, key=lambda x: (-len(x), x)))
            found += f"(?: (?:{given}) ){{{part.low},{part.high}}}"
    return found


def _license_sql() -> str:
    patterns = ", ".join(
        f"('{label}', '{_template_pattern(license_templates.parse(markup))}')"
        for _, label, markup in TEMPLATES
    )
    phrases = ", ".join(
        f"('{label}', {phrase.split(' ')!r})" for phrase, label in BASE_PHRASES.items()
    )
    return rf"""
        with words as (
            select doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
            from documents
        ),
        phrases(label, p) as (values {phrases}),
        patterns(label, pattern) as (values {patterns}),
        places as (
            select doc_id, label, s - 1 as start
            from (select doc_id, w, unnest(generate_series(1, len(w))) as s from words) t, phrases
            where w[s] = p[1] and list_slice(w, s, s + len(p) - 1) = p
        ),
        base as (
            select doc_id, count(*) as n_base, min(start) as first_word, max(start) as last_word,
                string_agg(distinct label, ',' order by label) as base_labels
            from places group by doc_id
        ),
        accepted as (
            select doc_id, label, unnest(regexp_extract_all(' ' || array_to_string(w, '  ') || ' ', pattern)) as found
            from words, patterns
        ),
        labelled as (
            select doc_id, string_agg(distinct label, ',' order by label) as labels
            from (select doc_id, label from places union all select doc_id, label from accepted)
            group by doc_id
        ),
        longest as (
            select doc_id, max(len(string_split(trim(found), '  '))) as n from accepted group by doc_id
        )
        select words.doc_id, cast(len(w) as bigint) as n_words, coalesce(n_base, 0) as n_base,
            first_word, last_word, coalesce(base_labels, '') as base_labels,
            coalesce(labels, '') as labels,
            coalesce(n / len(w), cast(0 as double)) as score
        from words left join base using (doc_id) left join labelled using (doc_id)
            left join longest using (doc_id)
    """


_TRIE = r"""
    with numbered as (
        select conv_id as c, row_number() over (partition by conv_id order by turn nulls first) as d,
            [coalesce(role, ''), coalesce(text, '')] as said
        from conversations where conv_id is not null
    ),
    convs as (
        select c, xor(list_reduce(
            list_concat([4294967295], flatten(list_transform(string_split(cast(c as varchar), ''),
                lambda x: [cast(ascii(x) as bigint), -1, -1, -1, -1, -1, -1, -1, -1]))),
            lambda s, y: case when y >= 0 then xor(s, y) when s & 1 = 1 then xor(s >> 1, 3988292384)
                else s >> 1 end), 4294967295) % 4 as h
        from (select distinct c from numbered)
    ),
    rebuilt as (
        select convs.c, 0 as own, d, said
        from convs join numbered n on n.c = convs.c - convs.c % 20 and n.d <= h
        union all
        select convs.c, 1, d, said from convs join numbered n on n.c = convs.c and n.d > h
    ),
    paths as (
        select convs.c, coalesce(list(said order by own, d) filter (where said is not null), []) as path
        from convs left join rebuilt using (c) group by convs.c
    ),
    steps as (
        select c, unnest(generate_series(0, len(path))) as depth, path from paths
    ),
    nodes as (
        select list_slice(path, 1, depth) as node, depth, min(c) as conv_id, count(*) as n_convs,
            sha256(coalesce(string_agg(cast(c as varchar), ',' order by c)
                filter (where depth = len(path)), '')) as ends_sha256
        from steps group by node, depth
    ),
    counted as (
        select n.*, list_slice(node, 1, depth - 1) as up,
            (n_convs - 1) * case when depth = 0 then 0
                else len(regexp_extract_all(node[depth][2], '[^\x20\x09-\x0D]+')) end as saved,
            (select count(*) from nodes k where k.depth = n.depth + 1
                and list_slice(k.node, 1, n.depth) = n.node) as n_children
        from nodes n
    ),
    sums as (
        select list_slice(b.node, 1, a.d) as node, sum(saved) as saved_tokens,
            count(*) filter (where n_children = 0) as n_leaves
        from counted b, (select unnest(generate_series(0, (select max(depth) from nodes))) as d) a
        where a.d <= b.depth
        group by list_slice(b.node, 1, a.d)
    )
    select t.conv_id, t.depth, p.conv_id as parent_conv_id, t.n_convs, t.n_children, s.n_leaves,
        cast(s.saved_tokens as bigint) as saved_tokens, t.ends_sha256
    from counted t join sums s on s.node = t.node
        left join nodes p on p.depth = t.depth - 1 and p.node = t.up
"""

ORACLE_SQL: dict[str, str] = {
    "op11_license_templates": _license_sql(),
    "op13_conversation_trie": _TRIE,
    "op2_token_count_rollup": r"""
        with counted as (
            select doc_id, source, lang,
                len(regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0b\f\r]+')) as words,
                len(regexp_extract_all(coalesce(text, ''),
                    '[^ \t\n\x0b\f\r]*[A-Za-z][^ \t\n\x0b\f\r]*')) as letters,
                len(regexp_extract_all(coalesce(text, ''),
                    '[A-Za-z]+|[0-9]|[^ \t\n\x0b\f\rA-Za-z0-9]')) as pieces
            from documents
            where doc_id not in (select doc_id from labels where quality = 0)
        )
        select source, lang, 'words-1' as tokenizer, count(*) as n_docs,
            cast(sum(case when lang = 'en' then letters else words end) as bigint) as n_tokens
        from counted group by source, lang
        union all
        select source, lang, 'pieces-2', count(*), cast(sum(pieces) as bigint)
        from counted group by source, lang
    """,
    "op6_substring_dedup": f"""
        with {_UNITS}
        select doc_id, cast(start as bigint) as start, cast(stop as bigint) as "end",
            cast(units as bigint) as units, cast(words as bigint) as words, kept_id
        from cut
    """,
}
