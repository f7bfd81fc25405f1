"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A sketch holds, for each cell, how many digests fall into it and the exclusive
or of those digests and of their check hashes; each digest falls into three
cells.  Sketches of two versions subtract cell by cell: what both hold cancels
out.  A cell with one digest left gives that digest away, it is taken out of its
other cells, and so on (peeling) until the differing digests of both sides are
known.

A text's digests are dealt by their first bits to parts of a few digests each,
with a small sketch a part, so that making and peeling take time in proportion
to the text.  A fingerprint is these sketches as text.  A part's sketch is made
wider until it peels by itself, so two fingerprints say all that is needed to
compare them: where the difference of two parts does not peel, both are peeled
alone, and the digests they give compared.

Everything here is a DataFrame expression.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairgrade.llm.common import id_text

#: Paragraphs are lines, cut further after sentences: in ASCII text after those
#: that end in one of these letters (about every third), else after every stop of
#: any script.  Long lines would make likeness coarse.
PARAGRAPH_END = r"\n| (?<=[a-g][.!?] )| (?<=[^\x00-\x7F][.!?] )|(?<=[\p{Po}&&[^\x00-\x7F]])"
PART_DIGESTS = 6
WIDTH = 6
RETRIES = 10
ROUNDS = 10
BUCKET_ROWS = 1000
MAX_BUCKETS = 20_000


NONE = "cast(array() as array<bigint>)"
CELLS = "array<struct<n:int,k:bigint,h:bigint>>"


def _let(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` standing for ``value``, evaluated once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _check(digest: str) -> str:
    return f"(xxhash64({digest}, 7) & 4294967295L)"


def _entry(digest: str, sign: str, width: str) -> str:
    """A digest with its sign, check hash and three cells, one in each third."""
    spot = "cast(({0}) * w_ + (shiftrightunsigned(g_, {1}) & 1048575) % w_ as int)".replace("w_", width)
    cells = ", ".join(f"'{n}', {spot.format(i, 20 * i)}" for i, n in enumerate("xyz"))
    made = f"named_struct('d', {digest}, 's', {sign}, 'h', {_check(digest)}, {cells})"
    return _let(f"xxhash64({digest}, 1)", "g_", made)


def _thirds(width: str, one) -> str:
    """The cells of all thirds; ``one(spot, c)`` makes the ``c``-th of the
    third that the field ``spot`` of an entry points to."""
    return "concat(" + ", ".join(
        f"transform(sequence({i} * {width}, {i + 1} * {width} - 1), c_ -> {one(spot, 'c_')})"
        for i, spot in enumerate("xyz")) + ")"


def _entries(digests: str, width: str) -> str:
    return f"transform({digests}, d_ -> {_entry('d_', '1', width)})"


def _cells(entries: str, width: str) -> str:
    add = "(s_, e_) -> named_struct('n', s_.n + 1, 'k', s_.k ^ e_.d, 'h', s_.h ^ e_.h)"
    return _thirds(width, lambda spot, c: (
        f"aggregate(filter({entries}, e_ -> e_.{spot} = {c}), named_struct('n', 0, 'k', 0L, 'h', 0L), {add})"))


def _sketch(digests: str, width: str) -> str:
    """The cells of an array of digests: (n, k, h)."""
    return _let(_entries(digests, width), "all_", _cells("all_", width))


def _peels(entries: str) -> str:
    """Whether the sketch of some entries, all of one side, peels: a round takes
    those that are alone in one of their cells."""
    shared = " and ".join(f"size(filter(r_, o_ -> o_.{spot} = e_.{spot})) > 1" for spot in "xyz")
    return (f"aggregate(sequence(1, {ROUNDS}), {entries}, "
            f"(r_, i_) -> if(size(r_) = 0, r_, filter(r_, e_ -> {shared})), r_ -> size(r_) = 0)")


def _subtract(left: str, right: str) -> str:
    return (f"zip_with({left}, {right}, (m_, o_) -> "
            "named_struct('n', m_.n - o_.n, 'k', m_.k ^ o_.k, 'h', m_.h ^ o_.h))")


def _peel(cells: str, width: str) -> str:
    """(a, b): the digests that only the left and only the right side holds;
    null if the cells can't be emptied."""
    pure = (f"array_distinct(transform(filter(t_.cells, p_ -> p_.n = {{0}} and p_.h = {_check('p_.k')}), "
            "p_ -> p_.k))")
    found = (f"concat(transform(pos_, d_ -> {_entry('d_', '1', width)}), "
             f"transform(neg_, d_ -> {_entry('d_', '-1', width)}))")
    take = "(s_, e_) -> named_struct('n', s_.n - e_.s, 'k', s_.k ^ e_.d, 'h', s_.h ^ e_.h)"
    rest = _thirds(width, lambda spot, c: _let(f"element_at(t_.cells, {c} + 1)", "u_", (
        f"if(u_.k = 0L, u_, aggregate(filter(f_, e_ -> e_.{spot} = {c}), u_, {take}))")))
    step = _let(found, "f_", f"if(size(f_) = 0, named_struct('cells', t_.cells, 'a', t_.a, 'b', t_.b, 'end', true), "
                             f"named_struct('cells', {rest}, "
                             "'a', concat(t_.a, pos_), 'b', concat(t_.b, neg_), 'end', false))")
    step = _let(pure.format(1), "pos_", _let(pure.format(-1), "neg_", step))
    done = "forall(t_.cells, v_ -> v_.n = 0 and v_.k = 0L and v_.h = 0L)"
    return (f"aggregate(sequence(1, {ROUNDS}), named_struct('cells', {cells}, 'a', {NONE}, 'b', {NONE}, 'end', false), "
            f"(t_, i_) -> if(t_.end, t_, {step}), t_ -> if({done}, named_struct('a', t_.a, 'b', t_.b), null))")


def _parts(sorted_digests: str, bits: str) -> str:
    """Sorted digests as one array for each value of their first bits, in order."""
    part = "if(b_ = 0, 0, cast(shiftright(v_, 64 - b_) + shiftleft(1L, b_ - 1) as int))"
    grown = _let(part, "at_", "if(at_ = a_.p, named_struct('p', a_.p, 'own', concat(a_.own, array(v_)), 'out', a_.out), "
                 "named_struct('p', at_, 'own', array(v_), "
                 f"'out', concat(a_.out, array(a_.own), array_repeat({NONE}, at_ - a_.p - 1))))")
    start = f"named_struct('p', 0, 'own', {NONE}, 'out', cast(array() as array<array<bigint>>))"
    return _let(bits, "b_", f"aggregate({sorted_digests}, {start}, (a_, v_) -> {grown}, a_ -> "
                f"concat(a_.out, array(a_.own), array_repeat({NONE}, shiftleft(1, b_) - 1 - a_.p)))")


def _bits(size: str) -> str:
    """First bits that make parts of about ``PART_DIGESTS``."""
    return f"cast(ceil(log2(greatest({size} / {PART_DIGESTS}D, 1D))) as int)"


def _widths(first: int) -> str:
    return "array(" + ", ".join(str(WIDTH * 2 ** i) for i in range(first, RETRIES)) + ")"


def fingerprint(digests: str) -> str:
    """The number of digests and the sketches of all parts as text: each cell's
    count, digests and checks, nothing for an empty cell.  Equal sets of digests
    give equal text.  A part takes the first width at which its
    own sketch peels."""
    cell = "if(v_.n = 0, '', concat(v_.n, '/', v_.k, '/', v_.h))"
    sketch = _let(_entries("g_", "w_"), "all_", f"if({_peels('all_')}, {_cells('all_', 'w_')}, null)")
    fits = (f"aggregate({_widths(0)}, cast(null as {CELLS}), "
            f"(got_, w_) -> if(got_ is not null, got_, {sketch}))")
    part = f"array_join(transform(coalesce({fits}, {_sketch('g_', str(WIDTH))}), v_ -> {cell}), ',')"
    return (f"concat(size({digests}), ':', array_join(transform("
            f"{_parts(f'sort_array({digests})', _bits(f'size({digests})'))}, g_ -> {part}), ';'))")


def _read(part: str) -> str:
    """The cells of a part's text."""
    cell = "named_struct('n', cast(x_[0] as int), 'k', cast(x_[1] as bigint), 'h', cast(x_[2] as bigint))"
    return (f"transform(split({part}, ','), c_ -> if(c_ = '', named_struct('n', 0, 'k', 0L, 'h', 0L), "
            + _let("split(c_, '/')", "x_", cell) + "))")


def _apart(left: str, right: str) -> str:
    """(a, b) of two arrays of digests."""
    return f"named_struct('a', array_except({left}, {right}), 'b', array_except({right}, {left}))"


def _wider(left: str, right: str, first: int) -> str:
    """(a, b) of two arrays of digests by sketches of growing width; of a part
    that none of them peels (two digests in the same three cells each time), from
    the digests."""
    tried = _peel(_subtract(_sketch(left, "w_"), _sketch(right, "w_")), "w_")
    return (f"coalesce(aggregate({_widths(first)}, cast(null as struct<a:array<bigint>,b:array<bigint>>), "
            f"(got_, w_) -> if(got_ is not null, got_, {tried})), {_apart(left, right)})")


def difference(left: str, right: str) -> str:
    """For each part, (a, b): the digests that only one of two arrays holds, from
    subtracted sketches.  Digests are even: the last bit tells the side where both
    are merged."""
    merged = f"sort_array(concat({left}, transform({right}, r_ -> r_ | 1L)))"
    sides = ("named_struct('l', filter(g_, d_ -> d_ & 1L = 0L), "
             "'r', transform(filter(g_, d_ -> d_ & 1L = 1L), d_ -> d_ ^ 1L))")
    return (f"transform({_parts(merged, _bits(f'greatest(size({left}), size({right}))'))}, "
            f"g_ -> {_let(sides, 'side_', _wider('side_.l', 'side_.r', 1))})")


def _alone(cells: str) -> str:
    """The digests of a part, from its own cells."""
    return f"{_peel(cells, f'cast(size({cells}) / 3 as int)')}.a"


def fingerprint_difference(left: str, right: str) -> str:
    """For each part, (a, b): the digests that only one of two fingerprints holds.

    Parts that have the same text hold the same.  Fingerprints of as many parts are
    subtracted part by part; a part whose difference does not peel, or whose
    sketches differ in width, is peeled alone on both sides, which gives all its
    digests.  Fingerprints of different numbers of parts are peeled alone; all
    that they hold is then one part."""
    direct = (f"if(size(l_) = size(r_), {_peel(_subtract('l_', 'r_'), 'cast(size(l_) / 3 as int)')}, null)")
    again = _let(f"named_struct('l', {_alone('l_')}, 'r', {_alone('r_')})", "own_", _apart("own_.l", "own_.r"))
    both = _let(_read("lt_"), "l_", _let(_read("rt_"), "r_", f"coalesce({direct}, {again})"))
    by_part = f"zip_with(lp_, rp_, (lt_, rt_) -> if(lt_ = rt_, named_struct('a', {NONE}, 'b', {NONE}), {both}))"
    all_of = "flatten(transform({0}, t_ -> " + _let(_read("t_"), "l_", _alone("l_")) + "))"
    whole = _let(all_of.format("lp_"), "ld_", _let(all_of.format("rp_"), "rd_", f"array({_apart('ld_', 'rd_')})"))
    parts = "split(substring_index({0}, ':', -1), ';')"
    return _let(parts.format(left), "lp_", _let(parts.format(right), "rp_",
                f"if(size(lp_) = size(rp_), {by_part}, {whole})"))


def _share(size: str, parts: str) -> str:
    """Share of digests that both sides hold among all; 1 if neither holds any."""
    lost = (f"aggregate({parts}, named_struct('a', 0, 'b', 0), "
            "(s_, p_) -> named_struct('a', s_.a + size(p_.a), 'b', s_.b + size(p_.b)))")
    return _let(size, "size_", _let(lost, "lost_", "if(size_ + lost_.b = 0, 1D, "
                                    "coalesce((size_ - lost_.a) / (size_ + lost_.b), 0D))"))


def fingerprint_likeness(left: str, right: str) -> str:
    """Share of paragraphs that two fingerprints have in common, from nothing but
    their texts.  0 for one of them that holds a part that no width peels."""
    size = f"cast(substring_index({left}, ':', 1) as int)"
    return f"if({left} = {right}, 1D, {_share(size, fingerprint_difference(left, right))})"


def likeness(left: str, right: str) -> Column:
    """Share of digests that two arrays have in common, by their sketches."""
    return F.expr(_share(f"size({left})", difference(left, right)))


def digests(text: Column) -> Column:
    """The distinct hashes of a text's paragraphs (blank ones left out), even."""
    parts = F.filter(F.transform(F.split(text, PARAGRAPH_END), lambda p: F.trim(p)), lambda p: p != "")
    return F.array_distinct(F.transform(parts, lambda p: F.xxhash64(p).bitwiseAND(F.lit(-2).cast("bigint"))))


def with_fingerprint(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with the fingerprint ``out`` of the column ``text``."""
    own = df.withColumn("_digests", digests(F.col(text)))
    return own.withColumn(out, F.expr(fingerprint("_digests"))).drop("_digests")


# ---------------------------------------------------------------------------
# The next document
# ---------------------------------------------------------------------------
def with_next(own: DataFrame) -> DataFrame:
    """``own`` (doc_id, text, fingerprint) with ``next_text``, the text of the next
    greater id (of texts that share it, the least), after the greatest id the first,
    and ``next_fingerprint``.

    Ids are dealt to buckets by quantiles; texts move once with their fingerprints,
    to their bucket, and look back there in descending order.  Only each bucket's
    first text is also sent to the bucket before, and sketched once more."""
    ids = own.where("doc_id is not null")
    n = ids.count()
    buckets = min(max(1, n // BUCKET_ROWS), MAX_BUCKETS)
    cuts = ids.select(F.col("doc_id").cast("double").alias("at")).approxQuantile(
        "at", [i / buckets for i in range(1, buckets)], 1 / (4 * buckets)) if n and buckets > 1 else []
    splits = [float("-inf"), *(sorted(set(cuts)) or [0.0]), float("inf")]
    dealt = (Bucketizer(splits=splits, inputCol="at", outputCol="bucket")
             .transform(own.withColumn("at", F.coalesce(F.col("doc_id").cast("double"), F.lit(0.0))))
             .withColumn("bucket", F.when(F.col("doc_id").isNotNull(), F.col("bucket").cast("int"))).drop("at"))

    firsts = dealt.where("bucket is not null").groupBy("bucket").agg(F.min("doc_id").alias("first"),
                                                                     F.max("doc_id").alias("last"))
    in_order = Window.partitionBy(F.lit(0)).orderBy("bucket")  # MAX_BUCKETS rows at most
    after = (firsts.withColumn("start", F.min("first").over(Window.partitionBy(F.lit(0))))
             .select("bucket", "last", F.coalesce(F.lead("first").over(in_order), "start").alias("doc_id")))
    heads = (F.broadcast(after).join(own.select("doc_id", F.col("text").alias("head")), "doc_id")
             .groupBy("bucket", "last").agg(F.min(F.coalesce("head", F.lit(""))).alias("head")))
    heads = with_fingerprint(heads, "head", "head_fingerprint")

    down = Window.partitionBy("bucket").orderBy(F.col("doc_id").desc(), F.col("text").desc())
    above = F.lag("doc_id").over(down)
    looked = (dealt.where("bucket is not null")
              .withColumn("new_id", above.isNull() | (above != F.col("doc_id")))
              .withColumn("near", F.when(F.col("new_id") & above.isNotNull(),
                                         F.struct(F.lag("text").over(down).alias("text"),
                                                  F.lag("fingerprint").over(down).alias("fingerprint"))))
              .withColumn("near", F.last("near", ignorenulls=True).over(
                  down.rowsBetween(Window.unboundedPreceding, 0)))
              .join(heads, "bucket", "left")
              .withColumn("is_last", F.col("doc_id") == F.col("last"))
              .select("doc_id", "text", "fingerprint",
                      F.when(F.col("is_last"), F.col("head")).otherwise(F.col("near.text")).alias("next_text"),
                      F.when(F.col("is_last"), F.col("head_fingerprint")).otherwise(F.col("near.fingerprint"))
                      .alias("next_fingerprint")))
    alone = dealt.where("bucket is null").select("doc_id", "text", "fingerprint", F.lit("").alias("next_text"))
    return looked.unionByName(with_fingerprint(alone, "next_text", "next_fingerprint"))


def document_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next), one row per input row.

    The edited text is the text with its last quarter (in code points, rounded
    down) replaced by as many from the beginning of the next document's text, or
    all of it.  A null text counts as empty.  A row without an id has no next
    document: its last quarter is just cut.  Rows that share an id have the same
    next document; rows that repeat give equal rows; other columns are ignored.
    An empty table gives no rows.  A very long text has more parts, not larger ones.

    ``near_*`` come from the fingerprints alone (``fingerprint_likeness``): those of
    the text and of the edited or the next text.
    """
    own = with_fingerprint(id_text(docs, id_col, text_col).withColumn("text", F.coalesce("text", F.lit(""))),
                           "text", "fingerprint")
    quarter = F.floor(F.col("n_chars") / 4).cast("int")
    read = (with_next(own).withColumn("n_chars", F.length("text").cast("bigint"))
            .withColumn("edited", F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - quarter),
                                           F.substring("next_text", F.lit(1), quarter))))
    prints = with_fingerprint(read, "edited", "edited_fingerprint")
    return prints.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        F.expr(fingerprint_likeness("fingerprint", "edited_fingerprint")).alias("near_edited"),
        F.expr(fingerprint_likeness("fingerprint", "next_fingerprint")).alias("near_next"))
