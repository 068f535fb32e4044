"""The daily jobs. Every step stores its day partition and the next one reads it,
so a step can be rerun alone and no lineage spans two steps."""

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.constants import (
    HAN_CLASS,
    MIN_TOKENS,
    NEAR_BITS,
    NON_TOPIC_CLASSES,
    REST_SUFFIX,
    VIEW_EVENT,
)
from pagemill.functions.hashing import BLOCKS, simhash
from pagemill.functions.text import drop_tagged, join_words, nonblank, parse_tagged
from pagemill.operators import neardup, textprep, topics, userstats
from pagemill.operators.taxonomy import Taxonomy
from pagemill.plans.store import Store
from pagemill.schemas import (
    ARTICLES,
    CLICK_LOG,
    DISCARD,
    DISTANCE,
    DUP,
    DUP_TOPICS,
    EDITOR_TOPICS,
    FID_CAT,
    HASH,
    KEY,
    LABEL_COUNTS,
    MEMBERS,
    PAGES,
    PREDICTION,
    READER_LOG,
    SAME,
    SEG,
    TRAIN,
    USER_PV,
    USER_TOPICS,
    conform,
)
from pagemill.sources.tables import ensure_parallelism, write_training

# Partitions wanted before words are cut.
MIN_PARTITIONS = 200


@dataclass(frozen=True)
class Cutting:
    """How text becomes words: kept characters, cutting mode, parallelism."""

    script: str = HAN_CLASS
    mode: str = "han"
    partitions: int = MIN_PARTITIONS

    def source(self, df: DataFrame) -> DataFrame:
        return ensure_parallelism(df, self.partitions, "fid")


def _clusters(store: Store, hashes: DataFrame, day: int, k: int) -> DataFrame:
    """Store exact groups, the four merge rounds and all members; the last round."""
    same = store.write(neardup.same_hash(hashes), "same", day, SAME)
    level, rounds = same, []
    for block in range(BLOCKS):
        merged = neardup.merge_round(level.select("fid", "hash", "samelen"), k, block)
        level = store.write(merged, f"distance_{k}_{block}", day, DISTANCE)
        rounds.append(level)
    store.write(neardup.cluster_members(hashes, same, rounds), "members", day, MEMBERS)
    return level


def near_duplicates(
    store: Store,
    pages: DataFrame,
    lexicon: DataFrame,
    day: int,
    k: int = NEAR_BITS,
    threshold: int = 2,
    cutting: Cutting = Cutting(),
    min_tokens: int = MIN_TOKENS,
) -> DataFrame:
    """Clusters of near copies among crawled pages, and a report of the large ones."""
    pages = conform(pages, PAGES)
    source = cutting.source(pages.select("fid", "fcontent"))
    cut = textprep.segment_pages(source, cutting.script, cutting.mode)
    kept = textprep.drop_classes(cut, lexicon)
    seg = store.write(kept.select("fid", join_words(F.col("words"), ",").alias("words")), "seg", day, SEG)

    wordy = seg.where(nonblank(F.col("words")))
    hashed = wordy.select("fid", simhash(F.split("words", ","), min_tokens).alias("hash"))
    hashes = store.write(hashed, "hash", day, HASH)

    clusters = _clusters(store, hashes, day, k)
    return store.write(neardup.dup_report(clusters, pages, threshold), "dup", day, DUP)


def page_topics(
    store: Store,
    pages: DataFrame,
    lexicon: DataFrame | None,
    junk_hashes: DataFrame,
    junk_urls: DataFrame,
    models: topics.Classifier,
    day: int,
    k: int = NEAR_BITS,
    threshold: int = 2,
    cutting: Cutting = Cutting(),
    junk_titles: DataFrame | None = None,
) -> DataFrame:
    """Parent and child topics of pages that are not junk, and a report of large
    clusters of near copies with their topics."""
    pages = conform(pages, PAGES)
    source = cutting.source(pages.select("fid", "fcontent", "furl", "ftitle"))
    key = store.write(
        textprep.prepare_pages(source, cutting.script, cutting.mode, lexicon), "key", day, KEY
    )
    kept = store.write(
        neardup.discard(key, junk_hashes, junk_urls, junk_titles), "discard", day, DISCARD
    )
    parents = store.write(topics.classify_parent(kept, models), "pcat", day, PREDICTION)
    children = topics.children_by_parent(parents, models)
    child_cat = store.write(children, "ccat", day, PREDICTION, by="model")

    clusters = _clusters(store, kept.select("fid", "hash"), day, k)
    report = neardup.dup_report(clusters, pages, threshold, child_cat)
    return store.write(report, "dup_topics", day, DUP_TOPICS)


def tagged_topics(
    store: Store,
    tagged: DataFrame,
    models: topics.Classifier,
    day: int,
    classes: str = NON_TOPIC_CLASSES,
) -> DataFrame:
    """Parent and child topics of (fid, words) rows whose words come tagged with their
    class, as ``word/class,word/class``; words of the listed classes are dropped."""
    kept = drop_tagged(parse_tagged(F.col("words")), classes)
    seg = store.write(tagged.select("fid", join_words(kept).alias("words")), "tagged_seg", day, SEG)
    parents = store.write(topics.classify_parent(seg, models), "tagged_pcat", day, PREDICTION)
    children = topics.children_by_parent(parents, models)
    return store.write(children, "tagged_ccat", day, PREDICTION, by="model")


def matching_pages(
    store: Store, hashes: DataFrame, listed: DataFrame, day: int, k: int = NEAR_BITS
) -> DataFrame:
    """Pages whose fingerprint is within ``k`` bits of a listed one."""
    return store.write(neardup.match_hashes(hashes, listed, k), f"match_{k}", day, HASH)


def user_topics(
    store: Store,
    articles: DataFrame,
    log: DataFrame,
    clicks: DataFrame,
    models: topics.Classifier,
    day: int,
    event: str = VIEW_EVENT,
    editor_only: bool = False,
    cutting: Cutting = Cutting(),
    rest: str = REST_SUFFIX,
) -> DataFrame:
    """Topics read per user, from editor topics and predicted ones."""
    articles = conform(articles, ARTICLES)
    log, clicks = conform(log, READER_LOG), conform(clicks, CLICK_LOG)
    reads = store.write(userstats.user_reads(log, event), "user_pv", day, USER_PV)
    editor = store.write(topics.editor_topics(articles, reads), "uc", day, EDITOR_TOPICS)

    predictions = None
    if not editor_only:
        prepared = textprep.prepare_articles(articles, reads, cutting.mode)
        prepared = prepared.persist()
        title = store.write(textprep.title_words(prepared), "title_seg", day, SEG)
        content = store.write(textprep.content_words(prepared), "content_seg", day, SEG)
        prepared.unpersist()
        stacked = []
        for name, part in (("title", title), ("content", content)):
            parents = store.write(topics.classify_parent(part, models), f"{name}_pcat", day, PREDICTION)
            children = topics.classify_children(parents, models)
            stacked += [parents, store.write(children, f"{name}_ccat", day, PREDICTION)]
        predictions = topics.union_predictions(*stacked)

    fid_cat = store.write(topics.article_topics(editor, predictions), "fid_cat", day, FID_CAT)
    counts = userstats.user_topic_counts(reads, fid_cat, clicks, rest)
    return store.write(counts, "imei_cat_cnt", day, USER_TOPICS)


def training_data(
    store: Store,
    articles: DataFrame,
    taxonomy: Taxonomy,
    lexicon: DataFrame,
    day: int,
    text: str = "title",
    cutting: Cutting = Cutting(),
) -> DataFrame:
    """Labelled training text per model, and the number of rows per label."""
    source = cutting.source(conform(articles, ARTICLES))
    rows = textprep.training_rows(source, taxonomy, lexicon, cutting.mode)
    train = store.write(rows, "train", day, TRAIN)
    labelled = textprep.labelled_rows(train, taxonomy, text)
    write_training(textprep.training_lines(labelled, taxonomy), training_path(store, day))
    return store.write(textprep.label_counts(labelled), "label_counts", day, LABEL_COUNTS)


def training_path(store: Store, day: int) -> str:
    return store.path(f"training/stat_date={day}")
