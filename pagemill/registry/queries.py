"""One query per operator, each over the whole of the shared tables."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.functions import text as tx
from pagemill.functions.hashing import within
from pagemill.operators import neardup, taxonomy, textprep, topics, userstats
from pagemill.plans import jobs
from pagemill.plans.store import Store
from pagemill.registry.standins import DAY, REST, StandIns
from pagemill.schemas import PREDICTION
from pagemill.sources import tables
from pagemill.sources.scratch import materialize, scratch_path

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def _query(fn: Callable[[StandIns], DataFrame]) -> Callable[[StandIns], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(StandIns(spark, sf_dir))

    _REGISTRY[fn.__name__] = run
    return fn


def queries() -> dict[str, Query]:
    return dict(_REGISTRY)


# Sources and sinks


@_query
def read_day_pruned(v: StandIns) -> DataFrame:
    path = scratch_path(v.spark, "reader_log")
    v.reader_log().write.partitionBy("stat_date").parquet(path)
    return tables.read_day(v.spark, path, 20240115, ["imei", "article_id", "event_name"])


@_query
def written_day_readback(v: StandIns) -> DataFrame:
    path = scratch_path(v.spark, "documents")
    docs = v.documents().select("fid", "ftitle", "fcontent", "lang")
    tables.write_day(docs, path, DAY)
    tables.write_day(docs.withColumn("ftitle", F.lit("")), path, DAY + 1)
    return tables.read_day(v.spark, path, DAY)


@_query
def category_partition_readback(v: StandIns) -> DataFrame:
    path = scratch_path(v.spark, "by_category")
    tables.write_day(v.documents().select("fid", "ftitle", "fcontent", "lang"), path, DAY, by="lang")
    return tables.read_day(v.spark, path, DAY, ["fid", "ftitle", "fcontent"], F.col("cat_part") == "de")


@_query
def dimension_read(v: StandIns) -> DataFrame:
    return tables.read_table(v.spark, f"{v.dir}/documents.parquet", ["doc_id", "lang", "n_chars"])


@_query
def list_lookup_export(v: StandIns) -> DataFrame:
    listed, out = scratch_path(v.spark, "ids"), scratch_path(v.spark, "export")
    v.junk_ids().select(F.format_string("  %d ", "fid")).write.text(listed)
    rows = v.documents().select("fid", tx.words(F.col("fcontent")).alias("words"))
    hash_ = neardup.simhash(F.col("words")).alias("hash")
    hashed = rows.select("fid", tx.join_words(F.col("words")).alias("words"), hash_)
    tables.export_ids(hashed, tables.read_list(v.spark, listed, as_long=True), out)
    return v.spark.read.schema("fid bigint, words string, hash bigint").csv(out)


@_query
def parallel_scan(v: StandIns) -> DataFrame:
    return tables.ensure_parallelism(v.documents().select("fid", "furl"), 16, "fid")


@_query
def balanced_scan(v: StandIns) -> DataFrame:
    docs = v.documents().select("fid", "furl", "fcontent")
    return tables.balance_bytes(docs, 16, F.octet_length("fcontent")).withColumn("fcontent", F.md5("fcontent"))


@_query
def b64_content(v: StandIns) -> DataFrame:
    return v.articles().select("fid", tx.decode_b64(F.col("fcontent")).alias("content"))


# Text preparation


@_query
def strip_tags(v: StandIns) -> DataFrame:
    return v.pages().select("fid", tx.strip_tags(F.col("fcontent")).alias("text"))


@_query
def strip_html(v: StandIns) -> DataFrame:
    return v.pages().select("fid", tx.strip_html(F.col("fcontent")).alias("text"))


@_query
def squash_text(v: StandIns) -> DataFrame:
    return v.documents().select(
        "fid", tx.squash(F.col("fcontent")).alias("text"), tx.squash(F.col("fkeywords")).alias("keywords")
    )


@_query
def site_of_url(v: StandIns) -> DataFrame:
    return v.pages().select("fid", tx.site_of(F.col("furl")).alias("site"))


@_query
def null_to_empty(v: StandIns) -> DataFrame:
    return v.pages().select("fid", tx.blank_if_null(F.col("fkeywords")).alias("keywords"))


@_query
def keep_script(v: StandIns) -> DataFrame:
    return v.documents().select("fid", tx.keep_script(F.col("fcontent"), r"\p{L}").alias("text"))


@_query
def word_list(v: StandIns) -> DataFrame:
    return v.word_lists().select(
        "fid", F.size("words").alias("n_words"), tx.join_words(F.col("words"), ",").alias("words")
    )


@_query
def word_class_counts(v: StandIns) -> DataFrame:
    tagged = textprep.word_classes(v.word_lists(), v.lexicon())
    return tagged.groupBy("fid", "cls").agg(F.count(F.lit(1)).alias("n"), F.sum("pos").alias("pos_sum"))


@_query
def class_filter(v: StandIns) -> DataFrame:
    kept = textprep.drop_classes(v.word_lists(), v.lexicon())
    return kept.select("fid", tx.join_words(F.col("words")).alias("words"))


@_query
def class_filter_joined(v: StandIns) -> DataFrame:
    kept = textprep.drop_classes(v.word_lists(), v.lexicon(), max_bytes=0)
    return kept.select("fid", tx.join_words(F.col("words")).alias("words"))


def _any_id(df: DataFrame) -> DataFrame:
    """The rows under few ids, one of them null."""
    return df.withColumn("fid", F.nullif(F.col("fid") % 7, F.lit(0)))


@_query
def class_filter_any_id(v: StandIns) -> DataFrame:
    """Null and repeated ids, by both ways of dropping words."""
    both = [textprep.drop_classes(_any_id(v.word_lists()), v.lexicon(), max_bytes=b) for b in (None, 0)]
    return both[0].unionByName(both[1]).select("fid", tx.join_words(F.col("words")).alias("words"))


@_query
def min_word_len(v: StandIns) -> DataFrame:
    return v.word_lists().select("fid", tx.join_words(tx.min_word_len(F.col("words"), 2)).alias("words"))


def _tagged(v: StandIns) -> DataFrame:
    """Words of documents, those of three letters and more tagged with the language."""
    tag = F.when(F.length("lang") > 0, F.concat(F.lit("/"), "lang"))
    tagged = F.transform(
        tx.words(F.col("fcontent")), lambda w: F.when(F.length(w) > 2, F.concat(w, tag)).otherwise(w)
    )
    return v.documents().select("fid", F.array_join(tagged, ",").alias("words"))


@_query
def parse_tagged(v: StandIns) -> DataFrame:
    pairs = tx.parse_tagged(F.col("words"))
    return _tagged(v).select("fid", tx.join_words(tx.drop_tagged(pairs, "ef")).alias("words"))


@_query
def nonblank(v: StandIns) -> DataFrame:
    docs = v.documents()
    return docs.where(tx.nonblank(F.col("fkeywords")) & tx.nonblank_sql(F.col("ftitle"))).select("fid", "ftitle")


@_query
def prepared_articles(v: StandIns) -> DataFrame:
    return textprep.prepare_articles(v.articles(), _reads(v))


@_query
def training_rows(v: StandIns) -> DataFrame:
    return textprep.training_rows(v.articles(), v.taxonomy(), v.lexicon())


@_query
def prepared_pages(v: StandIns) -> DataFrame:
    return textprep.prepare_pages(v.pages(), r"\p{L}")


# Fingerprints and near copies


@_query
def simhash(v: StandIns) -> DataFrame:
    return v.hashes()


@_query
def hash_distance(v: StandIns) -> DataFrame:
    """Documents whose hash is within 20 bits of the hash of their own title."""
    docs = v.documents()
    body = neardup.simhash(tx.words(F.col("fcontent")))
    title = neardup.simhash(tx.words(F.col("ftitle")))
    pairs = docs.select("fid", body.alias("body_hash"), title.alias("title_hash"))
    return pairs.where(within(F.col("body_hash"), F.col("title_hash"), 20))


@_query
def same_hash(v: StandIns) -> DataFrame:
    return neardup.same_hash(v.hashes())


@_query
def same_members(v: StandIns) -> DataFrame:
    return _same_members(v)


def _same_members(v: StandIns) -> DataFrame:
    hashes = materialize(v.hashes())
    return neardup.same_members(hashes, materialize(neardup.same_hash(hashes)))


@_query
def block_keys(v: StandIns) -> DataFrame:
    return neardup.block_keys(v.hashes())


@_query
def near_pairs(v: StandIns) -> DataFrame:
    return neardup.near_pairs(materialize(neardup.same_hash(v.hashes())))


@_query
def near_pairs_3_bits(v: StandIns) -> DataFrame:
    return neardup.near_pairs(materialize(neardup.same_hash(v.hashes())), k=3)


@_query
def merge_round(v: StandIns) -> DataFrame:
    merged = neardup.merge_round(neardup.same_hash(v.hashes()), k=3, block=1)
    return merged.select("fid", "hash", "samelen", F.size("members").alias("n_members"))


def _clusters(v: StandIns, k: int = 1) -> tuple[DataFrame, DataFrame]:
    return neardup.near_dup_clusters(materialize(v.hashes()), k)


@_query
def near_dup_clusters(v: StandIns) -> DataFrame:
    return _clusters(v)[0].select("fid", "hash", "samelen")


@_query
def near_dup_clusters_3_bits(v: StandIns) -> DataFrame:
    return _clusters(v, 3)[0].select("fid", "hash", "samelen")


@_query
def near_dup_members(v: StandIns) -> DataFrame:
    return _clusters(v)[1]


@_query
def member_string(v: StandIns) -> DataFrame:
    return neardup.member_string(_same_members(v))


@_query
def member_string_parts(v: StandIns) -> DataFrame:
    return neardup.member_string(_same_members(v), part_ids=3)


def _junk_hashes(v: StandIns) -> DataFrame:
    junk = neardup.keep_ids(v.documents().select("fid", "fcontent"), v.junk_ids())
    hashed = neardup.hash_documents(junk.select("fid", tx.words(F.col("fcontent")).alias("words")))
    return materialize(hashed.select("hash"))


@_query
def hash_matches(v: StandIns) -> DataFrame:
    return neardup.match_hashes(v.hashes(), _junk_hashes(v))


@_query
def hash_matches_2_bits(v: StandIns) -> DataFrame:
    return neardup.match_hashes(v.hashes(), _junk_hashes(v), k=2)


@_query
def hash_matches_3_bits(v: StandIns) -> DataFrame:
    return neardup.match_hashes(v.hashes(), _junk_hashes(v), k=3)


@_query
def hash_matches_5_bits(v: StandIns) -> DataFrame:
    return neardup.match_hashes(v.hashes(), _junk_hashes(v), k=5)


@_query
def hash_drop_3_bits(v: StandIns) -> DataFrame:
    return neardup.drop_hashes(v.hashes(), _junk_hashes(v), k=3)


@_query
def hash_drop(v: StandIns) -> DataFrame:
    return neardup.drop_hashes(v.hashes(), _junk_hashes(v))


@_query
def url_drop(v: StandIns) -> DataFrame:
    sites = v.pages().select("fid", tx.site_of(F.col("furl")).alias("furl"))
    return neardup.drop_urls(sites, v.junk_urls())


@_query
def url_drop_joined(v: StandIns) -> DataFrame:
    sites = v.pages().select("fid", tx.site_of(F.col("furl")).alias("furl"))
    return neardup.drop_urls(sites, v.junk_urls(), max_bytes=50)


@_query
def short_drop(v: StandIns) -> DataFrame:
    return neardup.drop_short(materialize(v.hashes()))


@_query
def title_drop(v: StandIns) -> DataFrame:
    return neardup.drop_titles(v.pages().select("fid", "ftitle"), v.junk_titles())


@_query
def title_drop_long_list(v: StandIns) -> DataFrame:
    """With a list that is not broadcast but tested by a Bloom filter and merged."""
    return neardup.drop_titles(v.pages().select("fid", "ftitle"), v.junk_titles(), max_bytes=0)


@_query
def discard(v: StandIns) -> DataFrame:
    keyed = materialize(textprep.prepare_pages(v.documents(), r"\p{L}"))
    urls = v.inline(value=["src1.", "//src17"])
    return neardup.discard(keyed, _junk_hashes(v), urls)


@_query
def discard_with_titles(v: StandIns) -> DataFrame:
    keyed = materialize(textprep.prepare_pages(v.pages(), r"\p{L}"))
    junk = materialize(keyed.join(v.junk_titles().toDF("ftitle"), "ftitle", "left_semi").select("hash"))
    return neardup.discard(keyed, junk, v.junk_urls(), v.junk_titles())


@_query
def dup_report(v: StandIns) -> DataFrame:
    return neardup.dup_report(neardup.same_hash(v.hashes()), v.documents(), 2)


@_query
def dup_report_long_list(v: StandIns) -> DataFrame:
    """With a list that is not broadcast but tested by a Bloom filter and merged."""
    return neardup.dup_report(neardup.same_hash(v.hashes()), v.documents(), 2, max_bytes=0)


@_query
def dup_report_topics(v: StandIns) -> DataFrame:
    labels = v.table("labels").select(
        F.col("doc_id").alias("fid"),
        F.when(F.col("quality") == 1, "good").otherwise("bad").alias("cat"),
        F.col("toxic").cast("double").alias("prob"),
    )
    return neardup.dup_report(neardup.same_hash(v.hashes()), v.documents(), 1, labels)


# Taxonomy


@_query
def normalized_category(v: StandIns) -> DataFrame:
    return v.articles().select("fid", taxonomy.normalize_cat(F.col("fcategory")).alias("cat"))


@_query
def mapped_category(v: StandIns) -> DataFrame:
    cats = v.articles().select("fid", F.col("fcategory").alias("cat"))
    return taxonomy.map_category(cats, v.taxonomy())


@_query
def allowed_label(v: StandIns) -> DataFrame:
    return taxonomy.allowed_label(mapped_category(v), v.taxonomy().labels)


@_query
def parents_with_children(v: StandIns) -> DataFrame:
    labels = allowed_label(v).select(F.replace("label", F.lit("_"), F.lit(",")).alias("label"))
    return taxonomy.parents_with_children(labels.distinct().unionByName(v.taxonomy().labels))


@_query
def label_parent(v: StandIns) -> DataFrame:
    return allowed_label(v).select("fid", taxonomy.parent_of(F.col("label")).alias("parent"))


@_query
def topic_split(v: StandIns) -> DataFrame:
    topic = taxonomy.split_topic(F.col("fcategory"), REST)
    return v.articles().select("fid", F.inline(F.array(topic)))


# Training lines and topics


def _labelled(v: StandIns) -> DataFrame:
    rows = textprep.training_rows(v.articles(), v.taxonomy(), v.lexicon())
    # Nothing below reads the titles, so they are not cut into words.
    train = materialize(rows.drop("title"))
    return textprep.labelled_rows(train, v.taxonomy(), "content")


def _lines(v: StandIns) -> DataFrame:
    return textprep.training_lines(_labelled(v), v.taxonomy())


@_query
def training_lines(v: StandIns) -> DataFrame:
    path = scratch_path(v.spark, "training")
    tables.write_training(_lines(v), path)
    return tables.read_training(v.spark, path)


@_query
def label_counts(v: StandIns) -> DataFrame:
    return textprep.label_counts(_labelled(v))


def _models(v: StandIns) -> topics.TopicModels:
    return topics.fit_topics(tables.split_training(_lines(v)))


def _rounded(predictions: DataFrame) -> DataFrame:
    return predictions.withColumn("prob", F.round("prob", 6))


def _documents(v: StandIns) -> DataFrame:
    return v.word_lists().select("fid", tx.join_words(F.col("words")).alias("words"))


@_query
def fit_topic_weights(v: StandIns) -> DataFrame:
    return topics.weight_rows(_models(v)).select(
        "model", "label", "word", F.round("log_weight", 6).alias("log_weight"), F.round("prior", 6).alias("prior")
    )


@_query
def parent_topics(v: StandIns) -> DataFrame:
    return _rounded(topics.classify_parent(_documents(v), _models(v)))


@_query
def parent_topics_any_id(v: StandIns) -> DataFrame:
    """Null and repeated ids, by both ways of scoring."""
    small = _models(v)
    large = topics.topic_models(small.weights, small.labels, max_bytes=0)
    docs = topics.numbered(_any_id(_documents(v)))
    both = [topics.classify_parent(docs, models) for models in (small, large)]
    return _rounded(both[0].unionByName(both[1]))


def _letters(model: str) -> topics.Scorer:
    """A classifier by first letters that leaves some texts unanswered and fails on others."""

    def score(texts):
        answers = []
        for text in texts:
            words = text.split(" ")
            if words[0].startswith("th"):
                raise ValueError(text)
            answers.append(None if len(words) % 5 == 0 else (f"__label__{model[:1]}{words[0][:2]}", -float(len(words) % 7)))
        return answers

    return score


@_query
def external_topics(v: StandIns) -> DataFrame:
    """Parent and child topics by an external classifier, with its missing answers and errors."""
    external = topics.ExternalModels(_letters, v.inline(model=["all", "ain", "aof"]))
    parents = materialize(topics.classify_parent(_documents(v), external))
    return _rounded(topics.union_predictions(parents, topics.classify_children(parents, external)))


@_query
def child_topics(v: StandIns) -> DataFrame:
    models = _models(v)
    return _rounded(topics.classify_children(materialize(topics.classify_parent(_documents(v), models)), models))


@_query
def child_topics_of_one(v: StandIns) -> DataFrame:
    models = _models(v)
    parents = materialize(topics.classify_parent(_documents(v), models))
    return _rounded(topics.classify_child(parents, models, "es"))


@_query
def fallback_topics(v: StandIns) -> DataFrame:
    """Keywords no model has seen, and blank ones, under both kinds of model."""
    models = _models(v)
    docs = v.documents()
    words = F.concat(F.col("fkeywords"), F.lit("zzz")).alias("words")
    parent = topics.classify_parent(docs.select("fid", words), models)
    children = topics.classify_children(docs.select("fid", words, F.col("lang").alias("cat")), models)
    return topics.union_predictions(parent, children)


@_query
def predicted_labels(v: StandIns) -> DataFrame:
    return topics.label_only(topics.classify_parent(_documents(v), _models(v)))


def _predictions(v: StandIns) -> DataFrame:
    """Title and content, parent and child predictions for uncategorised articles."""
    models = _models(v)
    prepared = materialize(textprep.prepare_articles(v.articles(), _reads(v)))
    stacked = []
    for part in (textprep.title_words(prepared), textprep.content_words(prepared)):
        parents = materialize(_rounded(topics.classify_parent(part, models)))
        stacked += [parents, _rounded(topics.classify_children(parents, models))]
    return topics.union_predictions(*stacked)


@_query
def stacked_predictions(v: StandIns) -> DataFrame:
    return _predictions(v)


@_query
def picked_topic(v: StandIns) -> DataFrame:
    return topics.pick_topic(_predictions(v))


@_query
def editor_topics(v: StandIns) -> DataFrame:
    return topics.editor_topics(v.articles(), _reads(v))


@_query
def article_topics(v: StandIns) -> DataFrame:
    return topics.article_topics(editor_topics(v), _predictions(v))


@_query
def article_topics_editor_only(v: StandIns) -> DataFrame:
    return topics.article_topics(editor_topics(v))


# Reader statistics


def _reads(v: StandIns) -> DataFrame:
    return materialize(userstats.user_reads(v.reader_log(), "view"))


@_query
def user_reads(v: StandIns) -> DataFrame:
    return _reads(v)


@_query
def distinct_reads(v: StandIns) -> DataFrame:
    return userstats.distinct_reads(_reads(v))


@_query
def reads_with_topics(v: StandIns) -> DataFrame:
    return userstats.reads_with_topics(_reads(v), article_topics_editor_only(v))


@_query
def clicks_union(v: StandIns) -> DataFrame:
    return userstats.topic_events(_reads(v), article_topics_editor_only(v), v.click_log())


@_query
def user_topic_counts(v: StandIns) -> DataFrame:
    return userstats.user_topic_counts(_reads(v), article_topics_editor_only(v), v.click_log(), REST)


@_query
def user_topic_counts_all(v: StandIns) -> DataFrame:
    return userstats.user_topic_counts(_reads(v), article_topics(v), v.click_log(), REST)


# The daily jobs, read back from what they store


def _store(v: StandIns) -> Store:
    return Store(v.spark, scratch_path(v.spark, "store"))


CUTTING = jobs.Cutting(script=r"\p{L}", mode="letters", partitions=16)


@_query
def job_near_duplicates(v: StandIns) -> DataFrame:
    return jobs.near_duplicates(_store(v), v.documents(), v.lexicon(), DAY, threshold=2, cutting=CUTTING)


@_query
def job_near_duplicate_members(v: StandIns) -> DataFrame:
    store = _store(v)
    jobs.near_duplicates(store, v.documents(), v.lexicon(), DAY, threshold=2, cutting=CUTTING)
    return store.read("members", DAY)


@_query
def job_tagged_topics(v: StandIns) -> DataFrame:
    """Parent topics as the job stores them, without the words."""
    store = _store(v)
    jobs.tagged_topics(store, _tagged(v), _models(v), DAY, "ef")
    return _rounded(store.read("tagged_pcat", DAY)).select("fid", "cat", "prob")


@_query
def job_matching_pages(v: StandIns) -> DataFrame:
    return jobs.matching_pages(_store(v), v.hashes(), _junk_hashes(v), DAY)


@_query
def job_training_data(v: StandIns) -> DataFrame:
    store = _store(v)
    return jobs.training_data(store, v.articles(), v.taxonomy(), v.lexicon(), DAY, "content", CUTTING)


def _user_topics(v: StandIns) -> DataFrame:
    log, clicks = v.reader_log(), v.click_log()
    return jobs.user_topics(
        _store(v), v.articles(), log, clicks, _models(v), DAY, "view", cutting=CUTTING, rest=REST
    )


@_query
def job_user_topics(v: StandIns) -> DataFrame:
    """The whole job, with topics predicted for the articles that editors left without one."""
    return _user_topics(v)


@_query
def job_user_topics_full(v: StandIns) -> DataFrame:
    """With topics predicted from title and content, parent and child, besides the editors' ones."""
    return _user_topics(v)


def _page_topics(v: StandIns) -> tuple[Store, DataFrame]:
    store = _store(v)
    urls = v.inline(value=["src1.", "//src17"])
    report = jobs.page_topics(
        store, v.documents(), v.lexicon(), _junk_hashes(v), urls, _models(v), DAY, cutting=CUTTING
    )
    return store, report


@_query
def job_page_topics(v: StandIns) -> DataFrame:
    """Parent topics of the pages that are not junk, as the job stores them."""
    return _rounded(_page_topics(v)[0].read("pcat", DAY))


@_query
def job_page_topics_children(v: StandIns) -> DataFrame:
    """Child topics of those pages, as the job stores them."""
    return _rounded(_page_topics(v)[0].read("ccat", DAY, PREDICTION))


@_query
def job_page_topics_report(v: StandIns) -> DataFrame:
    """The report of near copies with their topics that the job ends in."""
    return _rounded(_page_topics(v)[1])
