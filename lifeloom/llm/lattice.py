"""SentencePiece encoding and decoding as a relational lattice.

The text is read with one blank put before it, as the vocabulary expects.  It is cut into words only where no piece can
reach across: between characters of two classes (``CLASSES``) that no piece holds side by side (``words_of``).  The cuts are computed from
the pieces, so the best way through the uncut text is that through its words.  Every distinct word is encoded once:

1. its substrings, at most as long as the longest piece, are exploded and equi-joined to the piece table;
2. the matches are the edges of the word's lattice and are grouped by word (the words are already dealt out by word,
   so this costs no shuffle).  A word of more than ``SHORT`` characters goes in blocks that overlap by a piece, so that no
   row carries it whole; its edges meet again under a hash of the word;
3. a fold over the word's positions keeps the best way to each: fewest characters without a piece, then fewest pieces,
   then the smallest sum of ranks.  A character that no piece covers becomes its UTF-8 bytes as byte pieces.  The fold is
   an Arrow pass, linear in positions and edges, and runs over a long word without a border.

``encode`` does this for the frequent words: those that make up at least 1/``FREQUENT`` of all occurrences, longer ones in
proportion more, so that they have no more than ``FREQUENT * SHORT`` characters together, whatever the corpus.  Their ids are
sent to all tasks.  No occurrence leaves its row: an Arrow pass looks up the frequent words and runs the same lattice
for the other distinct words of its batch of texts, many words at once (``encode_batch``); then the ids are put to their places.
``decode`` looks ids up among the pieces and puts them together in order.  ``report`` goes through both.
"""

from __future__ import annotations

import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import same, settled

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
FREQUENT = 200_000
#: Classes of characters.
CLASSES = ("blank", "letter", "digit", "other")
#: Bytes of text whose words are looked up at once, and that are cut at once; a longer text goes alone.
PORTION, CUT = 1 << 22, 1 << 19
#: Longest word whose edges carry the word itself.
SHORT = 64
#: Cost of a piece beside its rank, and of a character as bytes: so many that neither is outweighed in any text.
PER_PIECE, PER_UNKNOWN = 1 << 50, 1 << 90
#: An edge is one long: where it ends, then its length, then the piece's id.
ID_BITS, LENGTH_BITS = 18, 6
#: The same costs for words of at most ``SHORT`` characters, and how many characters of them, with what fills them up, are folded at once.
SHORT_PIECE, SHORT_UNKNOWN, AT_ONCE = 1 << 24, 1 << 32, 1 << 16
#: A character has 21 bits; this one is in no text.
PAD = (1 << 21) - 1


def piece_table(spark: SparkSession, model: str = MODEL) -> DataFrame:
    """(piece, id, length, byte): pieces in plain text (a blank for the blank sign) and the byte pieces as ``<0x..>``.

    Its size is the vocabulary's, which is why it may be broadcast.
    """
    reader = sentencepiece.SentencePieceProcessor(model_file=model)
    rows = []
    for i in range(reader.get_piece_size()):
        if not (reader.is_control(i) or reader.is_unknown(i) or reader.is_unused(i)):
            piece = reader.id_to_piece(i) if reader.is_byte(i) else reader.id_to_piece(i).replace("▁", " ")
            rows.append((piece, i, len(piece), reader.is_byte(i)))
    if reader.get_piece_size() >= 1 << ID_BITS:
        raise ValueError(f"a vocabulary of {reader.get_piece_size()} pieces does not fit {ID_BITS} bits")
    return spark.createDataFrame(rows, "piece string, id int, length int, byte boolean")


def _class_of(c: str) -> int:
    return 0 if c == " " else 1 if unicodedata.category(c)[0] in "LM" else 2 if c in "0123456789" else 3


def cuts(pieces: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(kinds, parted): every character's class, and [a, b] whether a cut is between classes a and b: if they stand side by side in no piece."""
    kinds = np.array([_class_of(chr(c)) for c in range(0x110000)], np.uint8)
    parted = np.ones((len(CLASSES), len(CLASSES)), bool)
    for row in pieces.filter("not byte").select("piece").collect():
        of = [_class_of(c) for c in row.piece]
        parted[of[:-1], of[1:]] = False
    return kinds, parted


def slices(texts: pa.Array, most: int):
    """(first, length) of slices of about ``most`` bytes of text."""
    size = np.cumsum(pc.binary_length(texts.fill_null("")).to_numpy(zero_copy_only=False).astype(np.int64))
    k = 0
    while k < len(size):
        upto = max(k + 1, int(np.searchsorted(size, (size[k - 1] if k else 0) + most, "right")))
        yield k, upto - k
        k = upto


def portions(batch: pa.RecordBatch):
    """The rows of a batch in slices of about ``PORTION`` bytes of text."""
    return (batch.slice(*part) for part in slices(batch.column("text"), PORTION))


def words_of(texts: pa.Array, kinds: np.ndarray, parted: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """(the words of many texts in order, how many each has); a text's words make up the text behind one blank.  None for null or empty.

    ``CUT`` bytes are cut at once: what is kept of a byte meanwhile is some twenty times its size.
    """
    found = [_words_of(texts.slice(*part), kinds, parted) for part in slices(texts, CUT)]
    words = pa.concat_arrays([pa.array([], pa.string()), *(words for words, _ in found)])
    return words, np.concatenate([np.zeros(0, np.int64), *(n for _, n in found)])


def _words_of(texts: pa.Array, kinds: np.ndarray, parted: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    texts = texts.fill_null("")
    whole = pa.concat_arrays([pc.if_else(pc.equal(texts, ""), "", pc.binary_join_element_wise(" ", texts, ""))])
    bounds = np.concatenate(([0], np.cumsum(pc.binary_length(whole).to_numpy(zero_copy_only=False)))).astype(np.int64)
    if not bounds[-1]:
        return pa.array([], pa.string()), np.zeros(len(texts), np.int64)
    first = np.frombuffer(whole.buffers()[1], np.int32)[whole.offset]
    data = whole.buffers()[2].slice(int(first), int(bounds[-1]))
    kind = kinds[np.frombuffer(data.to_pybytes().decode().encode("utf-32-le"), np.uint32)]
    at = np.flatnonzero(np.frombuffer(data, np.uint8) & 0xC0 != 0x80)
    starts = np.concatenate(([True], parted[kind[:-1], kind[1:]]))
    starts[np.searchsorted(at, bounds[:-1][np.diff(bounds) > 0])] = True
    begin = at[starts]
    offsets = np.append(begin, bounds[-1]).astype(np.int32)
    words = pa.StringArray.from_buffers(len(begin), pa.py_buffer(offsets), data)
    return words, np.diff(np.searchsorted(begin, bounds))


def best_way(word: str, edges: list[int], first_byte: int) -> list[int]:
    """The ids of the cheapest way through a word.  Equal costs: the longest last piece."""
    n, at = len(word), 0
    cost, back = [0] * (n + 1), [0] * (n + 1)
    ids, lengths = (1 << ID_BITS) - 1, (1 << LENGTH_BITS) - 1
    edges.sort()
    for end in range(1, n + 1):
        best, way = cost[end - 1] + PER_UNKNOWN, None
        while at < len(edges) and edges[at] >> (ID_BITS + LENGTH_BITS) == end:
            edge = edges[at]
            this = cost[end - (edge >> ID_BITS & lengths)] + PER_PIECE + (edge & ids)
            # Edges of one end come shortest first.
            if this <= best:
                best, way = this, edge
            at += 1
        cost[end], back[end] = best, way
    found, end = [], n
    while end:
        edge = back[end]
        if edge is None:
            found.extend(first_byte + b for b in reversed(word[end - 1].encode()))
            end -= 1
        else:
            found.append(edge & ids)
            end -= edge >> ID_BITS & lengths
    return found[::-1]


def _edges(keyed: DataFrame, pieces: DataFrame, longest: int) -> DataFrame:
    """(keys, edge) of (keys, text, first, fresh): the pieces that start among the ``fresh`` first characters of ``text``, which
    itself starts at ``first``.  One row without an edge stays for each text that would have none."""
    keys = [c for c in keyed.columns if c not in ("text", "first", "fresh")]
    starts = keyed.select("*", F.explode(F.sequence(F.lit(0), F.col("fresh") - 1)).alias("start"))
    reach = F.sequence(F.col("start") + 1, F.least(F.col("start") + longest, F.length("text")))
    cut = starts.select("*", F.explode(reach).alias("end"))
    cut = cut.withColumn("piece", F.substring("text", F.col("start") + 1, F.col("end") - F.col("start")))
    plain = pieces.filter("not byte").select("piece", "id")
    matched = cut.join(F.broadcast(plain), "piece", "left").filter("id is not null or (start = 0 and end = 1)")
    high = F.shiftleft((F.col("first") + F.col("end")).cast("long"), LENGTH_BITS).bitwiseOR((F.col("end") - F.col("start")).cast("long"))
    edge = F.shiftleft(high, ID_BITS).bitwiseOR(F.col("id").cast("long"))
    return matched.select(*keys, F.when(F.col("id").isNotNull(), edge).alias("edge"))


def encode_words(words: DataFrame, pieces: DataFrame) -> DataFrame:
    """(word, n, ids) for distinct ``word`` with a count ``n``.  ``words`` should be dealt out by word."""
    sizes = pieces.agg(F.max(F.when(~F.col("byte"), F.col("length"))), F.min(F.when(F.col("byte"), F.col("id")))).first()
    longest, first_byte = sizes[0] or 1, sizes[1]
    if longest >= 1 << LENGTH_BITS:
        raise ValueError(f"a piece of {longest} characters does not fit {LENGTH_BITS} bits")
    # Rows stay in the order of this number, which makes the sort that groups them again cheap; it is used in this stage only.
    short = words.filter(F.length("word") <= SHORT).select(
        F.monotonically_increasing_id().alias("place"), "word", "n", F.col("word").alias("text"), F.lit(0).alias("first"), F.length("word").alias("fresh")
    )
    grouped = _edges(short, pieces, longest).groupBy("place", "word").agg(F.first("n").alias("n"), F.collect_list("edge").alias("edges"))
    long = words.filter(F.length("word") > SHORT).select(F.sha2("word", 256).alias("key"), "word", "n")
    blocks = long.select("key", "word", F.explode(F.sequence(F.lit(0), F.length("word") - 1, F.lit(SHORT))).alias("first"))
    blocks = blocks.select(
        "key", F.substring(F.col("word"), F.col("first") + 1, F.lit(SHORT + longest - 1)).alias("text"), "first",
        F.least(F.lit(SHORT), F.length("word") - F.col("first")).alias("fresh"),
    )
    met = _edges(blocks, pieces, longest).groupBy("key").agg(F.collect_list("edge").alias("edges"))
    both = grouped.select("word", "n", "edges").unionByName(long.join(met, "key").select("word", "n", "edges"))

    def fold(batches):
        for batch in batches:
            found = [best_way(w, e, first_byte) for w, e in zip(batch.column("word").to_pylist(), batch.column("edges").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n"), pa.array(found, pa.list_(pa.int32()))], ["word", "n", "ids"])

    return both.mapInArrow(fold, "word string, n long, ids array<int>")


def vocabulary(rows: DataFrame, pieces: DataFrame) -> DataFrame:
    """(word, n, ids) of every distinct word of ``rows`` (words); n counts its occurrences."""
    words = rows.select(F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return encode_words(words, pieces)


def piece_tree(pieces: DataFrame) -> dict:
    """The pieces as a prefix tree in arrays: ``keys`` has a node's number and a character, ``to`` the node they lead to, ``ids`` each
    node's piece or -1.  Its size is the vocabulary's."""
    edges, ids, longest, first_byte = {}, [-1], 1, None
    for row in pieces.select("piece", "id", "byte").collect():
        if row.byte:
            first_byte = row.id if first_byte is None else min(first_byte, row.id)
            continue
        node = 0
        for c in row.piece:
            key = node << 21 | ord(c)
            if key not in edges:
                edges[key] = len(ids)
                ids.append(-1)
            node = edges[key]
        ids[node], longest = row.id, max(longest, len(row.piece))
    keys = np.array([*sorted(edges), np.iinfo(np.int64).max], np.int64)
    to = np.array([edges.get(k, 0) for k in keys.tolist()], np.int64)
    return {"keys": keys, "to": to, "ids": np.array(ids, np.int32), "longest": longest, "first_byte": first_byte}


def lattices(chars: np.ndarray, tree: dict) -> np.ndarray:
    """The pieces of many words: [length - 1, start, word] has a piece's id or -1.  ``chars`` has a column for each word, filled with PAD."""
    n, many = chars.shape
    found = np.full((min(tree["longest"], n), n, many), -1, np.int32)
    flat, plain = found.reshape(len(found), -1), chars.ravel()
    at = np.flatnonzero(plain != PAD)
    node = np.zeros(len(at), np.int64)
    for length in range(len(found)):
        key = node << 21 | plain[at + length * many]
        place = np.searchsorted(tree["keys"], key)
        there = tree["keys"][place] == key
        at, node = at[there], tree["to"][place[there]]
        flat[length, at] = tree["ids"][node]
        more = at < (n - length - 1) * many
        at, node = at[more], node[more]
    return found


def best_ways(chars: np.ndarray, sizes: np.ndarray, tree: dict) -> tuple[np.ndarray, np.ndarray]:
    """What ``best_way`` gives for many words of at most ``SHORT`` characters: (ids of all words in order, how many each word has)."""
    found = lattices(chars, tree)
    n, many = chars.shape
    cost, back = np.zeros((n + 1, many), np.int64), np.zeros((n + 1, many), np.int8)
    for end in range(1, n + 1):
        best = cost[end - 1] + SHORT_UNKNOWN
        for length in range(1, min(end, len(found)) + 1):
            piece = found[length - 1, end - length]
            this = cost[end - length] + SHORT_PIECE + piece
            better = (piece >= 0) & (this <= best)
            best = np.where(better, this, best)
            back[end][better] = length
        cost[end] = best
    at, steps = sizes.astype(np.int64), []
    live = np.flatnonzero(at)
    while len(live):
        end = at[live]
        length = back[end, live].astype(np.int64)
        # A character that no piece covers is written as its negative.
        token = np.where(length > 0, found[length - 1, end - length, live], -1 - chars[end - 1, live])
        steps.append((live, token))
        at[live] = end - np.maximum(length, 1)
        live = live[at[live] > 0]
    word, token = (np.concatenate([s[k] for s in reversed(steps)]) for k in (0, 1))
    order = np.argsort(word, kind="stable")
    word, token = word[order], token[order]
    bare = token < 0
    if bare.any():
        letters = [chr(-1 - t).encode() for t in token[bare].tolist()]
        times = np.ones(len(token), np.int64)
        times[bare] = [len(x) for x in letters]
        word, token, spelt = np.repeat(word, times), np.repeat(token, times), np.repeat(bare, times)
        token[spelt] = tree["first_byte"] + np.frombuffer(b"".join(letters), np.uint8).astype(np.int64)
    return token.astype(np.int32), np.bincount(word, minlength=many)


def encode_batch(words: pa.Array, tree: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, start, count): the ids of many distinct words; a word's are ``count`` from ``start`` on."""
    sizes = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    order = np.argsort(sizes, kind="stable")
    words, size = words.take(pa.array(order)).to_pylist(), sizes[order]
    count, parts, k = np.zeros(len(order), np.int64), [], 0
    while k < len(order):
        upto = k + 1
        if size[k] <= SHORT:
            # The words of a block are filled up to its longest.
            here = size[k : min(k + AT_ONCE, int(np.searchsorted(size, SHORT, "right")))]
            upto = k + max(1, int(np.searchsorted(here * np.arange(1, len(here) + 1), AT_ONCE, "right")))
        code = np.frombuffer("".join(words[k:upto]).encode("utf-32-le"), np.uint32).astype(np.int64)
        here = size[k:upto]
        column = np.repeat(np.arange(upto - k), here)
        chars = np.full((int(here[-1]), upto - k), PAD, np.int64)
        chars[np.arange(len(code)) - np.repeat(np.cumsum(here) - here, here), column] = code
        if size[k] > SHORT:
            found = lattices(chars, tree)[:, :, 0]
            length, start = np.nonzero(found >= 0)
            edges = ((start + length + 1) << LENGTH_BITS | length + 1) << ID_BITS | found[length, start]
            ids = np.array(best_way(words[k], edges.tolist(), tree["first_byte"]), np.int32)
            count[k] = len(ids)
        else:
            ids, count[k:upto] = best_ways(chars, here, tree)
        parts.append(ids)
        k = upto
    start, back = np.cumsum(count) - count, np.empty(len(order), np.int64)
    back[order] = np.arange(len(order))
    return np.concatenate(parts) if parts else np.empty(0, np.int32), start[back], count[back]


def _frequent(texts: DataFrame, pieces: DataFrame, frequent: int, sent) -> DataFrame:
    """(word, ids) of the frequent words of ``texts`` (text); ``sent`` has the cuts."""

    def counts(batches):
        cut = sent.value
        for batch in batches:
            for part in portions(batch):
                found = words_of(part.column("text"), *cut)[0].value_counts()
                yield pa.RecordBatch.from_arrays([found.field("values"), found.field("counts")], ["word", "n"])

    counted = texts.mapInArrow(counts, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counted = settled(counted, "lattice-words")
    total = counted.agg(F.sum("n")).first()[0] or 0
    known = counted.filter(F.col("n") * frequent >= total * F.greatest(F.lit(1.0), F.length("word") / SHORT))
    return vocabulary(known.select(F.array("word").alias("words")), pieces).select("word", "ids")


def encode(docs: DataFrame, model: str = MODEL, frequent: int = FREQUENT) -> DataFrame:
    """(doc_id, print, n_words, ids) of every row of ``docs``; null and empty texts have no ids.  ``print`` is the text's SHA-256.

    Rows stay in their tasks, so repeated rows and null ids stay apart.
    """
    context = docs.sparkSession.sparkContext
    pieces = piece_table(docs.sparkSession, model)
    text = F.make_valid_utf8("text").alias("text")
    cut = context.broadcast(cuts(pieces))
    known = _frequent(docs.select(text), pieces, frequent, cut).toArrow().combine_chunks()
    sent = context.broadcast((piece_tree(pieces), [c.combine_chunks() for c in known.columns]))

    def placed(batches):
        tree, (known_words, known_ids) = sent.value
        known_count = pc.list_value_length(known_ids).to_numpy(zero_copy_only=False).astype(np.int64)
        known_flat = known_ids.flatten().to_numpy(zero_copy_only=False).astype(np.int32)
        known_start = np.cumsum(known_count) - known_count
        for part in (part for batch in batches for part in portions(batch)):
            words, n_words = words_of(part.column("text"), *cut.value)
            coded = words.dictionary_encode()
            distinct, index = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
            place = pc.index_in(distinct, value_set=known_words)
            rare = place.is_null().to_numpy(zero_copy_only=False)
            place = place.fill_null(0).to_numpy(zero_copy_only=False)[~rare]
            start, count = np.empty(len(distinct), np.int64), np.empty(len(distinct), np.int64)
            own, own_start, count[rare] = encode_batch(distinct.filter(pa.array(rare)), tree)
            start[rare] = own_start + len(known_flat)
            start[~rare], count[~rare] = known_start[place], known_count[place]
            every = np.concatenate((known_flat, own))
            times = count[index]
            ends = np.concatenate(([0], np.cumsum(times)))
            ids = every[np.repeat(start[index] - ends[:-1], times) + np.arange(ends[-1])]
            rows = ends[np.concatenate(([0], np.cumsum(n_words)))].astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(rows), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("print"), pa.array(n_words, pa.int64()), lists], ["doc_id", "print", "n_words", "ids"])

    print_ = F.sha2(F.coalesce("text", F.lit("")), 256).alias("print")
    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), print_, text)
    return whole.mapInArrow(placed, "doc_id long, print string, n_words long, ids array<int>")


def decoded(ids, pieces: DataFrame) -> F.Column:
    """The text of an array of ids: each id looked up in the list of all pieces' bytes, which is as long as the vocabulary."""
    raw = F.when(F.col("byte"), F.substring("piece", 4, 2)).otherwise(F.hex(F.encode("piece", "UTF-8")))
    known = {r.id: r.raw for r in pieces.select("id", raw.alias("raw")).collect()}
    spelled = F.split(F.lit(",".join(known.get(i, "") for i in range(max(known, default=-1) + 1))), ",")
    text = F.decode(F.unhex(F.array_join(F.transform(ids, lambda i: spelled[i]), "")), "UTF-8")
    return F.substring(text, 2, 2**31 - 2)


def decode(coded: DataFrame, model: str = MODEL) -> DataFrame:
    """The rows of ``coded`` with ``text`` in place of ``ids``."""
    pieces = piece_table(coded.sparkSession, model)
    return coded.withColumn("text", decoded(F.col("ids"), pieces)).drop("ids")


def report(docs: DataFrame, model: str = MODEL, frequent: int = FREQUENT) -> DataFrame:
    """(doc_id, n_words, n_tokens, n_bytes, digest, round_trip) of every row of ``docs``.

    ``digest`` is the SHA-256 of the row's ids in order, as decimal numbers with commas.  The ids are decoded again: ``n_bytes``
    is the length of what comes out, ``round_trip`` tells if it is the text (by SHA-256).  Null and empty texts have no
    words.  Repeated rows stay repeated; null ids keep their rows; further columns are ignored.
    """
    coded = encode(docs, model, frequent)
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    told = coded.withColumn("n_tokens", F.size("ids").cast("long")).withColumn("digest", F.sha2(ids, 256))
    return decode(told, model).select(
        "doc_id", "n_words", "n_tokens", F.octet_length("text").cast("long").alias("n_bytes"), "digest",
        same(F.sha2("text", 256), F.col("print")).alias("round_trip"),
    )
