"""Secret scan: fixed patterns, and strings near sensitive words that a primed compressor finds new.

Candidates of the second kind are long runs of letters, digits and signs of keys with a word such as "token" anywhere in their
surroundings, before or after them and over line ends, and all runs that adjoin such a run. Their novelty is the
number of bytes that zstandard, primed with a dictionary of code and identifiers, needs for the surrounding text
with the candidate, less what it needs without; an identifier or a repeat costs little, a key about as many bytes
as it has. Lines of a block are also priced in the surroundings of the block, where its other lines do not help.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spinewise.llm.common import slices

# The base patterns by kind, with the least length of what must be long enough.
KINDS = ["assign", "access", "hex", "novel"]
BASE = {
    "assign": (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]+", 0, 24),
}
# What a text must hold to have a span of the kind; no more than a faster test.
GATES = {
    "assign": r"""(?i)(password|passwd|secret|token|api_?key)["']? *[:=]""",
    "access": r"AKIA[A-Z0-9]{16}",
    "hex": r"[0-9a-f]{24}",
    "novel": r"(?i)(passw|passphrase|secret|token|api.?key|access.?key|private.?key|signing.?key|bearer|credential|authorization|client.?id|connection.?string|webhook|kennwort|geheim|zugangs|schl(ü|ue)ssel|mot de passe|motdepasse|jeton|cl(é|e) (secr|priv|d.acc)|identifiant|contrase(ñ|n)a|clave|credencial|segreto|senha|chave)",
}
# Identifiers and words of code with which the compressor is primed.
IDENTIFIERS = """
import from return class public private static final const let var def self this new null true false None True False
string integer boolean float double object array list dict map set function lambda async await yield try except catch
finally raise throw if else elif for while switch case break continue package interface extends implements override
config configuration settings environment variable default value values name names index count size length width height
user username user_id account account_id session session_id request response header headers content content_type body
client server service endpoint url uri path file filename directory folder host hostname port address address_line
password passwd secret token access_token refresh_token api_key apikey private_key public_key client_id client_secret
authorization authentication bearer basic credential credentials connection_string database table column schema query
created_at updated_at deleted_at timestamp datetime date time version release build debug info warning error message
application/json text/html utf-8 http https www com org net example localhost 127.0.0.1 0.0.0.0 placeholder changeme
0123456789 abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 2019 2020 2021 2022 2023 2024 2025
the and that with from this have will your for are was not you all can has but its our their what which when where
""".strip()
# Plain text that fills up short surroundings. Few letters are not packed at all, and then a name costs
# as many bytes as a key.
PLAIN = " ".join("""
Every morning the old man walked down to the harbour, looked at the boats and asked the fishermen about their catch. Most
of them knew him well; some had sailed under him when they were young. He would sit on a low wall, fill his pipe, and talk
of storms, of far islands, and of ships that nobody else remembered. Towards noon, when the sun grew hot, he went back up
the hill through narrow streets, bought bread and a little fruit, and slept until the bells woke him. "There is no hurry,"
he used to say, "as long as somebody listens." In winter he stayed at home, mended nets and wrote long letters to friends.
""".split())

#: A candidate: so many characters at least, of any kind; its surroundings are so many characters on either side.
_RUN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
AROUND = 256
#: What may stand between adjoining runs: signs, white space and written line ends, or dots with short parts between them.
_LINK = re.compile(r"[\W_]*(?:\\[nrt][\W_]*)*|\.(?:[A-Za-z0-9+/_=-]*\.)+")
_PART = re.compile(r"[A-Za-z0-9+/_=-]+")
_LINE = re.compile(r"\n|\\(?=n)")
#: The short last line of a block of lines.
_LAST = re.compile(r"""["',;+\x20\t\r]*(?:\n|\\n|\\r\\n)["'\x20\t#>*]*([A-Za-z0-9+/_=-]{1,15})(?=["',;+\x20\t\r]*(?:\n|\\n|\\r|\Z))""")
#: Bytes needed for each character from which a candidate is reported.
NOVELTY = 0.7


class Scanner:
    def __init__(self, novelty: float = NOVELTY):
        import zstandard

        self.base = {kind: (re.compile(pattern, re.ASCII), group, least) for kind, (pattern, group, least) in BASE.items()}
        self.near = re.compile(GATES["novel"], re.ASCII)
        self.novelty = novelty
        dictionary = zstandard.ZstdCompressionDict(IDENTIFIERS.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        plain = zstandard.ZstdCompressionParameters.from_level(12, write_content_size=False, write_checksum=False, write_dict_id=False)
        self.pack = zstandard.ZstdCompressor(dict_data=dictionary, compression_params=plain).compress

    def marginal(self, text: str, start: int, end: int, whole: tuple[int, int] | None = None) -> float:
        """Bytes for each character that the candidate adds to its surroundings, or to those of the whole it is of."""
        first, last = whole or (start, end)
        before, after = text[max(0, first - AROUND) : first], text[last : last + AROUND]
        # The candidate comes last, so the text on both its sides is known when it is packed.
        around = (PLAIN[: 2 * AROUND - len(before + after)] + before + after).encode("utf-8", "replace")
        return (len(self.pack(around + text[start:end].encode())) - len(self.pack(around))) / (end - start)

    def blocks(self, text: str) -> Iterator[list[tuple[int, int]]]:
        """Adjoining runs, of which one at least has a sensitive word in its surroundings."""
        words = [m.span() for m in self.near.finditer(text)]
        block, sensitive, w = [], False, 0
        for m in _RUN.finditer(text):
            start, end = m.span()
            if block and not _LINK.fullmatch(text, block[-1][1], start):
                if sensitive:
                    yield block
                block, sensitive = [], False
            while w < len(words) and words[w][1] < start - AROUND:
                w += 1
            block.append((start, end))
            sensitive |= w < len(words) and words[w][0] <= end + AROUND
        if sensitive:
            yield block

    def novel(self, text: str, taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
        taken = sorted(taken)
        reach = list(accumulate((e for _, e in taken), max))
        out = []

        def free(start: int, end: int) -> bool:
            i = bisect_left(taken, (end,))
            return not i or reach[i - 1] <= start

        for block in self.blocks(text):
            found, whole = [], (block[0][0], block[-1][1])

            def new(start: int, end: int, whole: tuple[int, int] = whole) -> bool:
                return self.marginal(text, start, end) >= self.novelty or ((start, end) != whole and self.marginal(text, start, end, whole) >= self.novelty)

            for start, end in block:
                if free(start, end) and new(start, end):
                    found.append((start, end))
            # Short parts are priced with the run before them: those between dots, and the last line of several.
            short = []
            for (start, end), (after, _) in zip(block, block[1:], strict=False):
                short += [(start, m.start(), m.end()) for m in _PART.finditer(text, end, after) if text[end] == text[after - 1] == "."]
            if len(block) > 1 and _LINE.search(text, block[-2][1], block[-1][0]) and (last := _LAST.match(text, block[-1][1])):
                short.append((block[-1][0], *last.span(1)))
            priced = dict(found)
            found += [(s, e) for start, s, e in short if start in priced and free(s, e) and new(start, e)]
            out += found
        return sorted(out)

    def spans(self, text: str, kinds: list[str]) -> list[tuple[int, int, int]]:
        """(start, end, kind) in code points, by start and then kind."""
        found = []
        for kind in kinds:
            if kind != "novel":
                pattern, group, least = self.base[kind]
                found += [(m.start(), m.end(), KINDS.index(kind)) for m in pattern.finditer(text) if m.end(group) - m.start(group) >= least]
        if "novel" in kinds:
            found += [(s, e, KINDS.index("novel")) for s, e in self.novel(text, [f[:2] for f in found])]
        return sorted(found, key=lambda f: (f[0], f[2]))

    def scan(self, texts: pa.Array) -> dict[int, list[tuple[int, int, int]]]:
        """The spans of the texts that have any."""
        gates = {kind: pc.fill_null(pc.match_substring_regex(texts, gate), False).to_pylist() for kind, gate in GATES.items()}
        out = {}
        for i in range(len(texts)):
            kinds = [kind for kind in KINDS if gates[kind][i]]
            if kinds and (found := self.spans(texts[i].as_py(), kinds)):
                out[i] = found
        return out


def scan_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text", novelty: float = NOVELTY) -> DataFrame:
    """(doc_id, spans): for every row the spans found, an array of (kind, start, end) in code points, end exclusive.

    Base kinds are found as their patterns say, leftmost and not overlapping within a kind; novel spans overlap
    no base span. Null and empty texts have no span; repeated rows each give a row; nothing is shuffled; other
    columns of the input are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(novelty)
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            for part in slices(batch, 1):
                found = scanner.scan(part.column(1))
                spans = [[{"kind": KINDS[k], "start": s, "end": e} for s, e, k in found.get(i, ())] for i in range(part.num_rows)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(spans, kind)], names=["doc_id", "spans"])

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, spans array<struct<kind:string,start:long,end:long>>")


def redact_secrets(docs: DataFrame, text: str = "text", length: str | None = None, mask: str = "<secret>", novelty: float = NOVELTY) -> DataFrame:
    """All rows and columns, each run of overlapping spans in the text replaced by `mask`; `length`, if named, is counted anew."""
    at = docs.columns.index(text)
    counted = docs.columns.index(length) if length else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(novelty)
        for batch in batches:
            for part in slices(batch, at):
                found = scanner.scan(part.column(at))
                if found:
                    columns, texts = list(part.columns), part.column(at).to_pylist()
                    for i, spans in found.items():
                        texts[i] = masked(texts[i], spans, mask)
                    columns[at] = pa.array(texts, columns[at].type)
                    if counted is not None:
                        sizes = columns[counted].to_pylist()
                        columns[counted] = pa.array([len(texts[i]) if i in found else n for i, n in enumerate(sizes)], columns[counted].type)
                    part = pa.RecordBatch.from_arrays(columns, schema=part.schema)
                yield part

    return docs.mapInArrow(run, docs.schema)


def masked(text: str, spans: list[tuple[int, int, int]], mask: str) -> str:
    out, at = [], 0
    for start, end, _ in spans:
        if start >= at:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join([*out, text[at:]])


def secret_digest(docs: DataFrame) -> DataFrame:
    """Counts by kind, a hash of the base spans, and all spans as text."""
    found = scan_secrets(docs)
    # Spans are in order already, so arrays of them stay in order when filtered.
    written = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def of(kind: str) -> Column:
        return F.filter("spans", lambda s: s["kind"] == kind)

    return found.select(
        "doc_id",
        *[F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in KINDS if kind != "novel"],
        F.sha2(written(F.filter("spans", lambda s: s["kind"] != "novel")), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
        F.size(of("novel")).cast("long").alias("n_novel"),
    )
