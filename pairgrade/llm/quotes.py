"""Chat formatting by quotation linking.

A reply often repeats what it answers, each line behind one ``>`` a level.
Quoted lines are normalised, hashed and looked up among the earlier messages of
their conversation; a message is a reply to the one that holds most of what it
quotes at the lowest level.  Quoted lines whose source is found are left out of
the text, and messages are put into threads, in the order of the replies.

Everything here is a DataFrame expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairgrade.sources.sinks import materialize

MARKS = r"^(?:\s*>)+"
KEY = ["conv_id", "turn", "mark"]
_AT = "struct<turn:bigint,mark:bigint>"


def _depth(line: Column) -> Column:
    return F.length(F.regexp_replace(F.regexp_extract(line, MARKS, 0), "[^>]", ""))


def _normal(line: Column) -> Column:
    """Without quotation marks, lower-cased, white space collapsed."""
    bare = F.regexp_replace(line, MARKS, "")
    return F.trim(F.lower(F.regexp_replace(bare, r"\s+", " ")))


def _lines(messages: DataFrame) -> DataFrame:
    return (messages.select(*KEY, F.posexplode(F.split("text", "\n")).alias("n", "line"))
            .withColumn("depth", _depth(F.col("line")))
            .withColumn("normal", _normal(F.col("line"))))


def quote_sources(messages: DataFrame, lines: DataFrame) -> DataFrame:
    """(conv_id, turn, mark, n, depth, source): quoted lines with the
    last earlier message of the conversation that holds the line as its own.

    Equal lines meet in one ordered window, in which each takes the last source
    before it: no pairs are made, however often a line is quoted."""
    quoted = (lines.where("depth > 0 and normal <> ''")
              .select(*KEY, "n", "depth", F.xxhash64("normal").alias("h"), F.md5("normal").alias("h2"),
                      F.lit(0).alias("own")))
    involved = messages.join(quoted.select("conv_id").distinct(), "conv_id", "left_semi")
    own = (_lines(involved).where("depth = 0 and normal <> ''")
           .select(*KEY, F.xxhash64("normal").alias("h"), F.md5("normal").alias("h2"), F.lit(1).alias("own")).distinct())
    before = (Window.partitionBy("conv_id", "h", "h2").orderBy("turn", "mark", "own")
              .rowsBetween(Window.unboundedPreceding, -1))
    return (quoted.unionByName(own, allowMissingColumns=True)
            .withColumn("source", F.last(F.when(F.col("own") == 1, F.struct("turn", "mark")), ignorenulls=True)
                        .over(before))
            .where("own = 0 and source is not null").select(*KEY, "n", "depth", "source"))


def _padded(turn: Column) -> Column:
    return F.lpad(turn.cast("string"), 19, "0")


def roots(parents: DataFrame) -> DataFrame:
    """(conv_id, turn, mark, root, level, path) of replies (``parent``): the
    first message of the thread, the number of steps to it and the turns on the
    way, by doubling the steps until all have arrived."""
    now = materialize(parents.select(*KEY, F.col("parent").alias("root"), F.lit(1).alias("level"),
                                     _padded(F.col("turn")).alias("path")), "roots")
    while True:
        up = now.select("conv_id", F.struct("turn", "mark").alias("root"), F.col("root").alias("further"),
                        F.col("level").alias("more"), F.col("path").alias("above"))
        nxt = materialize(now.join(up, ["conv_id", "root"], "left")
                          .select(*KEY, F.coalesce("further", "root").alias("root"),
                                  (F.col("level") + F.coalesce("more", F.lit(0))).alias("level"),
                                  F.concat_ws("/", "above", "path").alias("path"),
                                  F.col("further").isNotNull().alias("moved")), "roots")
        now = nxt.drop("moved")
        if not nxt.where("moved").limit(1).count():
            return now


def linked_conversations(conversations: DataFrame, template: str = "<|{role}|>\n{text}") -> DataFrame:
    """(conv_id, turn, role, reply_to, thread, level, path, n_quotes, text,
    formatted), one row per input row.

    ``reply_to`` is the turn of the message replied to (null: of none that is
    known), ``thread`` the turn of the thread's first message, ``level`` the
    number of replies from there, ``path`` the turns from there to the message
    (19 digits each, null without a turn): in order of (conv_id, path) each
    message stands behind the one it replies to, before later messages of the
    same level (``in_reply_order``).  ``n_quotes`` is the number of quoted blocks
    of which ``text`` leaves out lines.  Of several sources the one with most
    lines counts, then the latest.  A quoted line goes if its source is known;
    one without words goes if all lines with words of its block go.
    ``formatted`` puts role and text into ``template``.

    A null text counts as empty; messages without a conversation or a turn are
    kept as they are, each a thread of its own; messages that share both are
    told apart by role and text; rows that repeat give equal rows; other columns
    are ignored.  An empty table gives no rows.  Lines of one message are sorted
    together, so a task needs memory for its longest text; a path grows with the
    number of replies in a row.
    """
    own = (conversations.select(F.col("conv_id").cast("bigint").alias("conv_id"),
                                F.col("turn").cast("bigint").alias("turn"),
                                F.col("role").cast("string").alias("role"),
                                F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
           .withColumn("mark", F.xxhash64(F.coalesce("role", F.lit("")), "text")))
    known = own.where("conv_id is not null and turn is not null").dropDuplicates(KEY)
    quoting = known.where(F.col("text").rlike(r"(?m)^\s*>"))
    of_message = Window.partitionBy(*KEY).orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    lines = materialize(_lines(quoting).withColumn("block", F.sum((F.col("depth") == 0).cast("int")).over(of_message)),
                        "quoting-lines")
    sources = materialize(quote_sources(known, lines), "quote-sources")

    votes = sources.groupBy(*KEY, "depth", "source").agg(F.count("*").alias("n"))
    parents = (votes.groupBy(*KEY).agg(F.max(F.struct(-F.col("depth"), "n", "source")).alias("best"))
               .select(*KEY, F.col("best.source").alias("parent")))
    linked = sources.select(*KEY, "n", F.lit(True).alias("linked"))
    of_block = Window.partitionBy(*KEY, "block")
    words = (F.col("depth") > 0) & (F.col("normal") != "")
    texts = (lines.join(linked, [*KEY, "n"], "left")
             .withColumn("known", words & F.col("linked").isNotNull())
             .withColumn("whole", F.bool_or("known").over(of_block)
                         & ~F.bool_or(words & ~F.col("known")).over(of_block))
             .withColumn("out", F.col("known") | ((F.col("depth") > 0) & (F.col("normal") == "") & F.col("whole")))
             .groupBy(*KEY).agg(
                 F.array_sort(F.collect_list(F.when(~F.col("out"), F.struct("n", "line")))).alias("kept"),
                 F.count_distinct(F.when(F.col("out"), F.col("block"))).alias("n_quotes"))
             .where("n_quotes > 0")
             .select(*KEY, "n_quotes", F.array_join(F.col("kept.line"), "\n").alias("own_text")))
    placed = parents.join(roots(parents), KEY).join(texts, KEY)

    body = F.coalesce("own_text", "text")
    lit = [F.lit(x) for x in template.replace("{role}", "\0r\0").replace("{text}", "\0t\0").split("\0")]
    pieces = [F.coalesce("role", F.lit("")) if p == "r" else body if p == "t" else x
              for p, x in zip(template.replace("{role}", "\0r\0").replace("{text}", "\0t\0").split("\0"), lit)]
    return (own.join(placed, KEY, "left")
            .select("conv_id", "turn", "role", F.col("parent.turn").alias("reply_to"),
                    F.coalesce("root.turn", "turn").alias("thread"),
                    F.coalesce("level", F.lit(0)).cast("bigint").alias("level"),
                    F.coalesce(F.concat(_padded(F.col("root.turn")), F.lit("/"), "path"), _padded(F.col("turn"))
                               ).alias("path"),
                    F.coalesce("n_quotes", F.lit(0)).cast("bigint").alias("n_quotes"),
                    body.alias("text"), F.concat(*pieces).alias("formatted")))


def in_reply_order(linked: DataFrame) -> DataFrame:
    """Conversations one after the other, each in the order of its replies."""
    return linked.orderBy("conv_id", "path", "role", "text")


#: The same for tables in which a turn is one message.
SQL = r"""
WITH RECURSIVE own AS (
  SELECT DISTINCT conv_id, turn, coalesce(text, '') AS text FROM conversations
  WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
split AS (
  SELECT conv_id, turn, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS n FROM own),
lines AS (
  SELECT conv_id, turn, n, line,
         length(regexp_replace(regexp_extract(line, '^(?:\s*>)+'), '[^>]', '', 'g')) AS depth,
         trim(lower(regexp_replace(regexp_replace(line, '^(?:\s*>)+', ''), '\s+', ' ', 'g'))) AS normal
  FROM split),
blocks AS (
  SELECT *, sum(CASE WHEN depth = 0 THEN 1 ELSE 0 END) OVER (
    PARTITION BY conv_id, turn ORDER BY n ROWS UNBOUNDED PRECEDING) AS block FROM lines),
sources AS (
  SELECT q.conv_id, q.turn, q.n, q.depth, max(o.turn) AS source
  FROM blocks q JOIN blocks o ON o.conv_id = q.conv_id AND o.normal = q.normal AND o.turn < q.turn
  WHERE q.depth > 0 AND q.normal <> '' AND o.depth = 0 GROUP BY ALL),
votes AS (SELECT conv_id, turn, depth, source, count(*) AS n FROM sources GROUP BY ALL),
parents AS (
  SELECT conv_id, turn, source AS parent FROM votes
  QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY depth, n DESC, source DESC) = 1),
up AS (
  SELECT conv_id, turn, parent, parent AS root, 1 AS level, lpad(CAST(turn AS VARCHAR), 19, '0') AS path FROM parents
  UNION ALL
  SELECT u.conv_id, u.turn, u.parent, p.parent, u.level + 1, lpad(CAST(u.root AS VARCHAR), 19, '0') || '/' || u.path
  FROM up u
  JOIN parents p ON p.conv_id = u.conv_id AND p.turn = u.root),
roots AS (
  SELECT * FROM up QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY level DESC) = 1),
marked AS (
  SELECT b.*, l.n IS NOT NULL AS known, b.depth > 0 AND b.normal <> '' AS words
  FROM blocks b LEFT JOIN sources l ON l.conv_id = b.conv_id AND l.turn = b.turn AND l.n = b.n),
gone AS (
  SELECT *, known OR (depth > 0 AND normal = '' AND bool_or(known) OVER w
                      AND NOT bool_or(words AND NOT known) OVER w) AS gone
  FROM marked WINDOW w AS (PARTITION BY conv_id, turn, block)),
texts AS (
  SELECT conv_id, turn, count(DISTINCT CASE WHEN gone THEN block END) AS n_quotes,
         coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (WHERE NOT gone), '') AS text
  FROM gone GROUP BY conv_id, turn)
SELECT c.conv_id, c.turn, c.role, r.parent AS reply_to, coalesce(r.root, c.turn) AS thread,
       coalesce(r.level, 0) AS level,
       coalesce(lpad(CAST(r.root AS VARCHAR), 19, '0') || '/' || r.path, lpad(CAST(c.turn AS VARCHAR), 19, '0')) AS path,
       coalesce(t.n_quotes, 0) AS n_quotes,
       coalesce(t.text, c.text, '') AS text,
       '<|' || coalesce(c.role, '') || '|>' || chr(10) || coalesce(t.text, c.text, '') AS formatted
FROM conversations c
LEFT JOIN roots r ON r.conv_id = c.conv_id AND r.turn = c.turn
LEFT JOIN texts t ON t.conv_id = c.conv_id AND t.turn = c.turn
"""
