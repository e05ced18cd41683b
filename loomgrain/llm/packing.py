"""Hierarchical multi-length packing of token sequences.

Context sizes are tiers, each twice the one before. A document is cut into full
windows of the largest tier and a rest; the rest goes to the smallest tier that
holds it. From the longest tier down, a window takes the longest rest of its
tier; its gap is filled with whole rests of shorter tiers, best fit first, and
then with a piece cut to measure. So every window is exactly as long as its
tier; what is left when fillers run out is cut to tiers as well. Sequences are
then dealt to step groups of like attention cost, the costliest first.

Packing runs in shards of about ``SHARD_TOKENS`` tokens along the rows of an
input partition. Tokens never leave the task that made them: no shuffle, memory
of one shard and the longest document, and a lost task is run again with the
same rows. Sequence ids hold the partition number, so which documents share a
sequence depends on how the input is split; what is packed does not.

Defined results: a NULL or empty text is the end token alone; rows that repeat
an id are packed each; no rows give no pieces; a NULL id stays NULL; only the
id and the text are read.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right, insort

import numpy as np
from pyspark.sql import DataFrame

from loomgrain.llm.common import worker_cache

WINDOW = 4096
SMALLEST_TIER = 256
SHARD_TOKENS = 1_000_000
STEP_TOKENS = 8 * WINDOW
END_ID = 2
KNOWN_WORDS = 700_000
ROWS_AT_ONCE = 512

# one run of letters is one token group for the tokenizer, whatever stands beside it but an apostrophe or a letter
PARTS = re.compile("([a-zß-öø-ÿ]*)([.,;:!?]*)([^\n]*)\n")


def tiers(window: int = WINDOW, smallest: int = SMALLEST_TIER) -> list[int]:
    found = [window]
    while found[0] > smallest:
        found.insert(0, found[0] // 2)
    return found


class Encoder:
    """Token ids of whole texts, looked up word by word.

    The tokenizer drops white space and never joins what stands on both sides
    of it, so the ids of a text are those of its words in turn. Words of plain
    letters are encoded many at a time and cut where a token ends a word; all
    others go through the tokenizer one by one. The tables are bounded. The
    strings of special tokens in a text are those tokens, as in the tokenizer's
    file, or with ``plain_specials`` ordinary text.
    """

    def __init__(self, path: str, plain_specials: bool = False):
        held = worker_cache(f"encoder:{path}:{plain_specials}")
        if not held:
            from tokenizers import Tokenizer, pre_tokenizers

            tokenizer = Tokenizer.from_file(path)
            tokenizer.encode_special_tokens = plain_specials
            # the same model for lower-case letters with blanks between, which need no normalising and no pattern
            plain = Tokenizer(tokenizer.model)
            byte_level = pre_tokenizers.ByteLevel(add_prefix_space=False, trim_offsets=True, use_regex=False)
            plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), byte_level])
            ends = np.zeros(tokenizer.get_vocab_size(), bool)
            for token, at in tokenizer.get_vocab().items():
                ends[at] = token.endswith("</w>")
            held.update(tokenizer=tokenizer, plain=plain, ends=ends, words={}, cores={})
        self.held, self.tokenizer, self.ends = held, held["tokenizer"], held["ends"]

    def one_by_one(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, np.uint32).tobytes() for x in found]

    def letters(self, cores: list[str], group: int = 1000) -> list[bytes]:
        made = []
        groups = [cores[i : i + group] for i in range(0, len(cores), group)]
        encoded = self.held["plain"].encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False)
        for words, found in zip(groups, encoded):
            ids = np.array(found.ids, np.uint32)
            lasts = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            if len(lasts) != len(words):
                made += self.one_by_one(words)
                continue
            data = ids.tobytes()
            made += [data[first:last] for first, last in zip([0, *lasts], lasts)]
        return made

    def learn(self, unknown: list[bytes]) -> None:
        words, cores = self.held["words"], self.held["cores"]
        # one pass over all of them; no word has a line break inside
        parts = PARTS.findall(b"\n".join(unknown).decode("utf-8").lower() + "\n")
        new = list({core for core, _, rest in parts if core and not rest} - cores.keys())
        cores.update(zip(new, self.letters(new)))
        ends = list({tail for core, tail, rest in parts if core and tail and not rest} - cores.keys())
        cores.update(zip(ends, self.one_by_one(ends)))
        odd = []
        for word, (core, tail, rest) in zip(unknown, parts):
            if rest or not core:
                odd.append(word)
            else:
                words[word] = cores[core] + cores[tail] if tail else cores[core]
        words.update(zip(odd, self.one_by_one([w.decode("utf-8") for w in odd])))

    def encode(self, texts: list[str | None], end_id: int = END_ID) -> list[np.ndarray]:
        """Ids of each text with the end token."""
        # blanks other than these stay inside a word and are left to the tokenizer
        split = [(text or "").encode("utf-8").split() for text in texts]
        words, end = self.held["words"], np.uint32(end_id).tobytes()
        needed = set().union(*split)
        for table in (words, self.held["cores"]):
            if len(table) + len(needed) > KNOWN_WORDS:
                table.clear()
        unknown = [w for w in needed if w not in words]
        if unknown:
            self.learn(unknown)
        return [np.frombuffer(b"".join(map(words.__getitem__, s)) + end, np.uint32) for s in split]


def pack(lengths: list[int], window: int = WINDOW, smallest: int = SMALLEST_TIER) -> list[list[tuple[int, int, int]]]:
    """Sequences as lists of (document, start, length); every sequence is as long as a power of two."""
    sizes = tiers(window, smallest)
    sequences, rests = [], []  # rests: (length, document, start), sorted
    for document, length in enumerate(lengths):
        full = length - length % window
        sequences += [[(document, at, window)] for at in range(0, full, window)]
        if length > full:
            rests.append((length - full, document, full))
    rests.sort()
    while rests:
        length, document, start = rests.pop()
        tier = next(size for size in sizes if size >= length)
        sequence, gap = [(document, start, length)], tier - length
        while gap and rests:
            at = bisect_right(rests, (gap, len(lengths), 0)) - 1
            if at >= 0:
                length, document, start = rests.pop(at)
                sequence.append((document, start, length))
                gap -= length
            else:
                # nothing fits whole: cut the shortest to measure
                length, document, start = rests.pop(0)
                sequence.append((document, start, gap))
                insort(rests, (length - gap, document, start + gap))
                gap = 0
        if gap == 0:
            sequences.append(sequence)
            continue
        sequences += cut_to_powers(sequence)
    return sequences


def cut_to_powers(pieces: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """The last window of a shard: its pieces in sequences of falling powers of two, which need no padding."""
    left = sum(length for _, _, length in pieces)
    queue, made = list(pieces), []
    while left:
        room = 1 << (left.bit_length() - 1)
        left -= room
        sequence = []
        while room:
            document, start, length = queue.pop(0)
            take = min(room, length)
            sequence.append((document, start, take))
            room -= take
            if take < length:
                queue.insert(0, (document, start + take, length - take))
        made.append(sequence)
    return made


def step_groups(sequences: list[list[tuple[int, int, int]]], step_tokens: int = STEP_TOKENS) -> list[int]:
    """A group per sequence: the costliest sequence goes to the group with the least attention cost so far."""
    import heapq

    total = sum(length for sequence in sequences for _, _, length in sequence)
    loads = [(0, group) for group in range(max(1, -(-total // step_tokens)))]
    costs = [sum(length * length for _, _, length in sequence) for sequence in sequences]
    groups = [0] * len(sequences)
    for at in sorted(range(len(sequences)), key=lambda i: (-costs[i], i)):
        load, group = heapq.heappop(loads)
        groups[at] = group
        heapq.heappush(loads, (load + costs[at], group))
    return groups


PIECES = (
    "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, `offset` long, "
    "sequence_tokens long, step_group long"
)


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    with_ids: bool = False,
    end_id: int = END_ID,
    window: int = WINDOW,
    smallest: int = SMALLEST_TIER,
    shard_tokens: int = SHARD_TOKENS,
    plain_specials: bool = False,
) -> DataFrame:
    """One row per piece: doc_id and PIECES; ``with_ids`` adds the token ids themselves.

    The tokenizer is used as its file has it; ``plain_specials`` takes the strings
    of special tokens in a text as ordinary text.
    """
    from pyspark.sql import types as T

    id_type = docs.schema["doc_id"].dataType
    wanted = T.StructType([T.StructField("doc_id", id_type), *T.StructType.fromDDL(PIECES).fields])
    if with_ids:
        wanted = wanted.add("ids", "array<int>")

    def work(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(wanted)
        encoder = Encoder(tokenizer_path, plain_specials)
        # ids of other partitions start 2^36 apart
        next_sequence = next_group = TaskContext.get().partitionId() << 36

        def shard(keys, tokens):
            nonlocal next_sequence, next_group
            sequences = pack([len(x) for x in tokens], window, smallest)
            groups = step_groups(sequences, 8 * window)
            rows = []
            for number, (sequence, group) in enumerate(zip(sequences, groups)):
                offset, total = 0, sum(length for _, _, length in sequence)
                for document, start, length in sequence:
                    ids = tokens[document][start : start + length]
                    row = (
                        keys[document], start, length, zlib.crc32(ids.tobytes()), len(tokens[document]),
                        next_sequence + number, offset, total, next_group + group,
                    )
                    rows.append((*row, ids.astype(np.int32)) if with_ids else row)
                    offset += length
            next_sequence += len(sequences)
            next_group += max(groups, default=-1) + 1
            columns = list(zip(*rows))
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

        keys, tokens, held = [], [], 0
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(first, ROWS_AT_ONCE)
                for key, ids in zip(part.column(0).to_pylist(), encoder.encode(part.column(1).to_pylist(), end_id)):
                    keys.append(key)
                    tokens.append(ids)
                    held += len(ids)
                    if held >= shard_tokens:
                        yield shard(keys, tokens)
                        keys, tokens, held = [], [], 0
        if keys:
            yield shard(keys, tokens)

    return docs.select("doc_id", "text").mapInArrow(work, wanted)
