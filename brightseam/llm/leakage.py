"""Same or near-same records across splits: a bipartite set-similarity join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dirt import is_blank, sha256_digest, source_code, split_name
from ..scratch import Scratch
from .images import image_id, pair_edges, table
from .survivors import latest_rows


def set_classes(side: DataFrame, scratch: Scratch, name: str, keep: tuple[str, ...] | None = None) -> tuple[DataFrame, DataFrame]:
    """(members, classes) of (id, shingles): members are (id, cls), classes (cls, s) with the shingles in order, each once.

    Ids with equal sets are one class, named by its least id, so copies, however many, meet others once.  Sets are told apart by
    two 64-bit hashes.  With ``keep`` every id has one row, which saves uniting them, and members have these columns too.
    """
    each = lambda c: F.array_sort(F.array_distinct(F.filter(c, lambda x: x.isNotNull())))
    sets = side.where("id is not null and shingles is not null")
    sets = sets.groupBy("id").agg(each(F.flatten(F.collect_list("shingles"))).alias("s")) if keep is None else sets.select("id", *keep, each(F.col("shingles")).alias("s"))
    sets = sets.where("size(s) > 0").select("id", *(keep or ()), "s", F.xxhash64("s").alias("h"), F.xxhash64("s", F.lit(1)).alias("g"))
    sets = scratch.cut(sets, f"{name}-sets")
    classes = scratch.cut(sets.groupBy("h", "g").agg(F.min("id").alias("cls"), F.first("s").alias("s")), f"{name}-classes")
    return sets.drop("s").join(classes.select("h", "g", "cls"), ["h", "g"]).select("id", *(keep or ()), "cls"), classes.select("cls", "s")


def overlapping_classes(held_out: DataFrame, train: DataFrame, threshold: float = 0.8, keep: tuple[str, ...] | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(pairs, eval members, train members): pairs (eval_class, train_class, overlap, eval_size, train_size) with Jaccard
    similarity of ``threshold`` or more, and (id, cls) of each side; ``keep`` as in ``set_classes``.

    Both inputs: (id bigint, shingles array<bigint>).  Exact.  Shingles are put in one order, the rarest among the
    held-out classes first; of a set of n only the first n - ceil(t n) + 1 can be the first shared with a partner
    (prefix filter).  Prefixes of the held-out side are the index; the training side probes it with
    its own, and drops partners by size (t m <= n <= m / t) and by the most that can still follow the
    position of the match.  Pairs that pass are verified on the whole sets, which are joined only then.
    NULL and empty sets match nothing; repeated shingles of a set count once; of repeated ids the sets are united.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be in (0, 1]")
    scratch = Scratch(held_out.sparkSession, "overlap")
    t = F.lit(float(threshold))
    ev_members, ev = set_classes(held_out, scratch, "eval", keep)
    tr_members, tr = set_classes(train, scratch, "train", keep)
    rare = scratch.cut(ev.select(F.explode("s").alias("s")).groupBy("s").agg(F.count(F.lit(1)).alias("f")), "rare")

    def ranked(classes: DataFrame) -> DataFrame:
        """(id, n, a: shingles in order).  A training shingle that no held-out set has comes first."""
        x = classes.select("cls", F.explode("s").alias("s")).join(rare, "s", "left").select("cls", F.struct(F.coalesce("f", F.lit(0)).alias("f"), "s").alias("x"))
        a = x.groupBy(F.col("cls").alias("id")).agg(F.array_sort(F.collect_list("x")).alias("a"))
        return a.select("id", "a", F.size("a").alias("n"))

    def prefix(side: DataFrame) -> DataFrame:
        keep = F.col("n") - F.ceil(t * F.col("n") - F.lit(1e-9)).cast("int") + 1
        return side.select("id", "n", F.posexplode(F.slice("a", F.lit(1), keep)).alias("i", "x")).where("x.f > 0").select("id", "n", "i", F.col("x.s").alias("s"))

    ev_sets, tr_sets = scratch.cut(ranked(ev), "eval-ranked"), scratch.cut(ranked(tr), "train-ranked")
    a, b = prefix(ev_sets).alias("a"), prefix(tr_sets).alias("b")
    need = F.ceil(t / (1 + t) * (F.col("a.n") + F.col("b.n")) - F.lit(1e-9))
    can = F.lit(1) + F.least(F.col("a.n") - F.col("a.i"), F.col("b.n") - F.col("b.i")) - 1
    # a later shared shingle sits deeper in both orders: the first one bounds the overlap from its place on
    hit = a.join(b, (F.col("a.s") == F.col("b.s")) & (F.col("b.n") >= F.col("a.n") * t - 1e-9) & (F.col("b.n") * t <= F.col("a.n") + 1e-9))
    firsts = hit.select(F.col("a.id").alias("eval_class"), F.col("b.id").alias("train_class"), (can >= need).alias("may"))
    pairs = firsts.where("may").select("eval_class", "train_class").distinct()
    whole = pairs.join(ev_sets.select(F.col("id").alias("eval_class"), F.col("a").alias("ea"), F.col("n").alias("eval_size")), "eval_class")
    whole = whole.join(tr_sets.select(F.col("id").alias("train_class"), F.col("a").alias("ta"), F.col("n").alias("train_size")), "train_class")
    both = whole.withColumn("overlap", F.size(F.array_intersect("ea.s", "ta.s")))
    union = F.col("eval_size") + F.col("train_size") - F.col("overlap")
    return both.where(F.col("overlap") >= t * union - 1e-9).select("eval_class", "train_class", "overlap", "eval_size", "train_size"), ev_members, tr_members


def cross_split_overlap(held_out: DataFrame, train: DataFrame, threshold: float = 0.8) -> DataFrame:
    """(eval_id, train_id, overlap, eval_size, train_size) of each pair: ``overlapping_classes`` with all members of the classes."""
    pairs, ev, tr = overlapping_classes(held_out, train, threshold)
    j = pairs.join(ev.select(F.col("cls").alias("eval_class"), F.col("id").alias("eval_id")), "eval_class")
    j = j.join(tr.select(F.col("cls").alias("train_class"), F.col("id").alias("train_id")), "train_class")
    return j.select("eval_id", "train_id", "overlap", "eval_size", "train_size")


def image_evidence(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """(images, evidence).  images: (id, path, source, digest, in_train, in_val, in_test); evidence: (id, listed, shingles), one set a piece.

    A whole digest is four shingles of 16 hex digits, tagged by place; a listed pair is a set of one shingle, the
    same for both its images.  Two pieces are alike at similarity 1 only.
    """
    scratch = Scratch(spark, "evidence")
    man = table(spark, folder, "embedding_manifest").select(image_id(F.col("path")).alias("id"), split_name(F.col("source_manifest")).alias("s"))
    man = man.where("id is not null and s is not null").groupBy("id").agg(*[F.max(F.col("s") == k).alias(f"in_{k}") for k in ("train", "val", "test")])
    audit = table(spark, folder, "image_audit").select(
        image_id(F.col("path")).alias("id"), "path", "audited_at", (~is_blank(F.col("error"))).alias("failed"), sha256_digest(F.col("sha256")).alias("digest"), source_code(F.col("capture_source")).alias("source")
    )
    audit = latest_rows(audit.where("id is not null"), "id", "audited_at", ["failed", "digest", "source", "path"])
    images = scratch.cut(audit.join(man, "id").select("id", "path", "source", "in_train", "in_val", "in_test", F.when(~F.col("failed"), F.col("digest")).alias("digest")), "images")
    blocks = F.array(*[F.xxhash64(F.lit(i), F.substring("digest", 16 * i + 1, 16)) for i in range(4)])
    digests = images.where("digest is not null").select("id", F.lit(False).alias("listed"), blocks.alias("shingles"))
    pairs = pair_edges(table(spark, folder, "near_duplicate_pairs"), "path_a", "path_b").distinct()
    known = images.select("id")
    pairs = pairs.join(known.withColumnRenamed("id", "u"), "u", "left_semi").join(known.withColumnRenamed("id", "v"), "v", "left_semi")
    link = F.array(F.xxhash64(F.lit("pair"), "u", "v"))
    listed = pairs.select(F.explode(F.array("u", "v")).alias("id"), F.lit(True).alias("listed"), link.alias("shingles"))
    return images, digests.union(listed)


def image_overlaps(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(images, pairs of classes, eval members, train members); members are (id, listed, cls) of images and their pieces of evidence."""
    scratch = Scratch(spark, "cross")
    images, evidence = image_evidence(spark, folder)
    evidence = evidence.join(images.select("id", "in_train", (F.col("in_val") | F.col("in_test")).alias("in_eval")), "id")
    # each piece is a set of its own, so a piece's id stands for an image and what kind of piece it is
    evidence = scratch.cut(evidence.distinct().withColumn("image", F.col("id")).withColumn("id", F.xxhash64("id", "shingles")), "pieces")
    pairs, ev, tr = overlapping_classes(evidence.where("in_eval"), evidence.where("in_train"), 1.0, ("image", "listed"))
    ev, tr = (m.select(F.col("image").alias("id"), "listed", "cls") for m in (ev, tr))
    return images, scratch.cut(pairs.select("eval_class", "train_class"), "pairs"), ev, tr


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """All pairs, as the case is defined; an image in train and in val or test pairs with itself."""
    images, pairs, ev, tr = image_overlaps(spark, folder)
    found = pairs.join(ev.select(F.col("cls").alias("eval_class"), F.col("id").alias("e")), "eval_class").join(tr.select(F.col("cls").alias("train_class"), F.col("id").alias("t")), "train_class")
    found = found.where("e <> t").select("e", "t").union(images.where("in_train and (in_val or in_test)").select(F.col("id").alias("e"), F.col("id").alias("t")))
    found = found.select(F.least("e", "t").alias("x"), F.greatest("e", "t").alias("y")).distinct()
    named = found.join(images.select(F.col("id").alias("x"), F.col("path").alias("p")), "x").join(images.select(F.col("id").alias("y"), F.col("path").alias("q")), "y")
    return named.select(F.least("p", "q").alias("path_a"), F.greatest("p", "q").alias("path_b"))


def p4_report(spark: SparkSession, folder: str) -> DataFrame:
    """Overlapping pairs, and images of the split that overlap with training, per split and capture source of the held-out image.

    Counted from the sizes of classes: copies are not expanded into pairs.
    """
    images, pairs, ev, tr = image_overlaps(spark, folder)
    of_class = tr.where("not listed").groupBy("cls").agg(F.count(F.lit(1)).alias("n"))
    held = ev.where("not listed").join(pairs, F.col("cls") == F.col("eval_class")).join(of_class.withColumnRenamed("cls", "train_class"), "train_class")
    alike = held.join(images.select("id", F.col("in_train").cast("int").alias("own")), "id").select("id", (F.col("n") - F.col("own")).alias("n"))
    links = ev.where("listed").join(pairs, F.col("cls") == F.col("eval_class")).select("id", "train_class").join(tr.where("listed").select(F.col("cls").alias("train_class"), F.col("id").alias("t")), "train_class")
    links = links.where("id <> t").select("id", "t").distinct().join(images.select("id", "digest"), "id").join(images.select(F.col("id").alias("t"), F.col("digest").alias("d")), "t")
    links = links.where("digest is null or d is null or digest <> d").groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    both = images.where("in_train and (in_val or in_test)").select("id", F.lit(1).cast("bigint").alias("n"))
    each = alike.unionByName(links).unionByName(both).groupBy("id").agg(F.sum("n").alias("n")).where("n > 0")
    j = each.join(images, "id").withColumn("split", F.explode(F.filter(F.array(F.when(F.col("in_val"), F.lit("val")), F.when(F.col("in_test"), F.lit("test"))), lambda x: x.isNotNull())))
    return j.groupBy("split", F.coalesce("source", F.lit("unknown")).alias("capture_source")).agg(F.sum("n").alias("pairs"), F.count(F.lit(1)).alias("images"))


def text_words(text: Column) -> Column:
    """Runs of other signs than blanks, in lower case as far as ASCII goes."""
    low = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.filter(F.split(low, "[ \\t\\r\\n\\f]+"), lambda x: x != "")


def word_shingles(words: str, width: int = 5) -> Column:
    """Hashes of each ``width`` words in a row; fewer words are one shingle, none give NULL.  ``words`` is a stored column: an
    expression would be worked out again for every shingle."""
    w = F.col(words)
    last = F.greatest(F.lit(1), F.size(w) - width + 1)
    return F.when(F.size(w) > 0, F.transform(F.sequence(F.lit(1), last), lambda i: F.xxhash64(F.array_join(F.slice(w, i, width), " "))))


def p4_texts(spark: SparkSession, folder: str, threshold: float = 0.8) -> DataFrame:
    """(doc_id, class_id, links): of each document with words whose image is in val or test, its class of equal shingle sets, named by the
    least document, and the training documents that share ``threshold`` of their shingles of five words with it.

    A document belongs to the splits of its image.  A document of both sides is no link of itself.
    """
    scratch = Scratch(spark, "texts")
    man = table(spark, folder, "embedding_manifest").select(image_id(F.col("path")).alias("image"), split_name(F.col("source_manifest")).alias("s")).where("image is not null and s is not null")
    man = man.groupBy("image").agg(F.max(F.col("s") == "train").alias("in_train"), F.max(F.col("s") != "train").alias("in_eval"))
    docs = table(spark, folder, "documents").select(F.col("doc_id").alias("id"), image_id(F.col("image_path")).alias("image"), "text").where("image is not null and text is not null")
    words = scratch.cut(docs.join(man, "image").select("id", "in_train", "in_eval", text_words(F.col("text")).alias("words")), "words")
    docs = scratch.cut(words.where("size(words) > 0").select("id", "in_train", "in_eval", word_shingles("words").alias("shingles")), "docs")
    pairs, ev, tr = overlapping_classes(docs.where("in_eval"), docs.where("in_train"), threshold, ("in_train",))
    size = tr.groupBy(F.col("cls").alias("train_class")).agg(F.count(F.lit(1)).alias("n"))
    links = pairs.join(size, "train_class").groupBy("eval_class").agg(F.sum("n").alias("n"))
    j = ev.join(links, ev["cls"] == links["eval_class"], "left").withColumn("own", F.col("in_train").cast("int"))
    return j.select(F.col("id").alias("doc_id"), F.col("cls").alias("class_id"), (F.coalesce("n", F.lit(0)) - F.when(F.col("n").isNotNull(), F.col("own")).otherwise(0)).cast("bigint").alias("links"))
