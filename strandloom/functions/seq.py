"""Sequence functions as columns: code generation or array functions, but for translation, which works on whole Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

BASES = "ACGT"
#: Bases and ambiguity codes with their complements.
IUPAC, IUPAC_COMPLEMENT = "ACGTRYKMBVDHSWNacgtrykmbvdhswn", "TGCAYRMKVBHDSWNtgcayrmkvbhdswn"
#: Two-bit codes of bases in packed k-mers.
PACKED = "GATC"

#: The standard genetic code, codons in the order T, C, A, G of each position.
CODE_ORDER = "TCAG"
STANDARD_CODE = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
#: Codons that other genetic codes read differently.
CODE_VARIANTS = {
    "universal": {},
    "Euplotes": {"TGA": "C"},
    "Tetrahymena": {"TAA": "Q", "TAG": "Q"},
    "Acetabularia": {"TAA": "Q", "TAG": "Q"},
    "Candida": {"CTG": "S"},
    "Mitochondrial-Canonical": {"TGA": "W", "ATA": "M"},
    "Mitochondrial-Vertebrates": {"TGA": "W", "ATA": "M", "AGA": "*", "AGG": "*"},
}
#: The ambiguity code of a set of bases.
AMBIGUITY = {"AG": "R", "CT": "Y", "GT": "K", "AC": "M", "CG": "S", "AT": "W", "CGT": "B", "ACG": "V", "AGT": "D", "ACT": "H", "ACGT": "N"}


def revcomp(seq: Column) -> Column:
    """Reverse complement; ambiguity codes and case are kept."""
    return F.reverse(F.translate(seq, IUPAC, IUPAC_COMPLEMENT))


def canonical(kmer: Column) -> Column:
    """The smaller of a k-mer and its reverse complement."""
    return F.least(kmer, revcomp(kmer))


def is_palindrome(kmer: Column) -> Column:
    return kmer == revcomp(kmer)


def pack(kmer: Column) -> Column:
    """A k-mer of at most 31 bases as a number of two bits a base, first base highest."""
    return F.coalesce(F.conv(F.translate(F.regexp_replace(kmer, f"[^{PACKED}]", ""), PACKED, "0123"), 4, 10).cast("long"), F.when(kmer.isNotNull(), 0))


def _digits(code: Column, k: int) -> Column:
    """A packed number's k digits to the base 4."""
    return F.lpad(F.conv(code.cast("string"), 10, 4), k, "0")


def unpack(code: Column, k: int) -> Column:
    """The k-mer of a packed number."""
    return F.translate(_digits(code, k), "0123", PACKED)


def packed_revcomp(code: Column, k: int) -> Column:
    """Reverse complement of a packed k-mer: codes of complements add up to 3, places are mirrored."""
    return F.conv(F.reverse(F.translate(_digits(code, k), "0123", "3210")), 4, 10).cast("long")


def base_count(seq: Column, base: str) -> Column:
    return F.length(seq) - F.length(F.replace(seq, F.lit(base), F.lit("")))


def entropy(seq: Column) -> Column:
    """Shannon entropy in bits over the four bases; other letters count for the length only."""
    total = F.lit(0.0)
    n = F.length(seq)
    for b in PACKED:
        p = base_count(seq, b) / n
        total = total + F.when(base_count(seq, b) > 0, -p * F.log2(p)).otherwise(0.0)
    return F.when(n > 0, total).otherwise(0.0)


def only_bases(seq: Column) -> Column:
    """Whether a sequence has no letter but A, C, G, T in either case."""
    return seq.rlike("^[ACGTacgt]+$")


def replace_other(seq: Column, by: str = "A") -> Column:
    return F.regexp_replace(seq, "[^ACGTacgt]", by)


def compress_runs(seq: Column) -> Column:
    """Homopolymer compression: each run of a base once."""
    return F.regexp_replace(seq, r"(.)\1+", "$1")


def codon_table(code: str = "universal") -> dict[str, str]:
    o = CODE_ORDER
    table = {a + b + c: STANDARD_CODE[16 * i + 4 * j + k] for i, a in enumerate(o) for j, b in enumerate(o) for k, c in enumerate(o)}
    return table | CODE_VARIANTS[code]


def _amino_table(code: str) -> np.ndarray:
    """The amino acid of 25 a + 5 b + c for letters a, b, c in the order T, C, A, G, other."""
    table = codon_table(code)
    letters = CODE_ORDER + "?"
    return np.frombuffer("".join(table.get(a + b + c, "X") for a in letters for b in letters for c in letters).encode(), np.uint8)


def translated(texts: pa.Array, frame: int, table: np.ndarray) -> pa.Array:
    """Amino acids of a batch of sequences. Letters of all sequences are looked up at once; on the other strand they are taken from each sequence's end."""
    texts = pc.utf8_upper(texts.fill_null(""))
    if pc.any(pc.not_equal(pc.binary_length(texts), pc.utf8_length(texts))).as_py():  # one byte a letter from here on
        texts = pc.replace_substring_regex(texts, r"[^\x00-\x7F]", "N")
    n = len(texts)
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + n + 1].astype(np.int64) if n else np.zeros(1, np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8) if n else np.zeros(0, np.uint8)
    letter = np.full(256, 4, np.int64)
    letter[list(CODE_ORDER.encode())] = range(4)
    codons = np.maximum(np.diff(ends) - (frame - 1) % 3, 0) // 3
    after = np.concatenate([[0], np.cumsum(codons)])
    place = (np.arange(after[-1]) - np.repeat(after[:-1], codons)) * 3 + (frame - 1) % 3
    if frame <= 3:
        at, step = np.repeat(ends[:-1], codons) + place, 1
    else:
        at, step = np.repeat(ends[1:], codons) - 1 - place, -1
        letter[list(CODE_ORDER.encode())] = [2, 3, 0, 1]  # complements
    if len(at):
        acids = table[letter[data[at]] * 25 + letter[data[at + step]] * 5 + letter[data[at + 2 * step]]]
    else:
        acids = np.zeros(0, np.uint8)
    return pa.StringArray.from_buffers(n, pa.py_buffer(after.astype(np.int32).tobytes()), pa.py_buffer(acids.tobytes()))


def translate_frame(seq: Column, frame: int = 1, code: str = "universal") -> Column:
    """Amino acids of frame 1 to 3, or 4 to 6 on the other strand. Unknown codons are X, a partial codon is dropped; a null is empty."""
    table = _amino_table(code)

    def run(texts: pa.Array) -> pa.Array:
        return translated(texts, frame, table)

    return F.arrow_udf(run, "string")(seq.cast("string"))


def stops(protein: Column) -> Column:
    return base_count(protein, "*")


def core_name(name: Column) -> Column:
    """A read's name without its mate: /1, /2, :1 and :2 at the end go."""
    return F.regexp_replace(name, r"[/:][12]$", "")


def mate_of(name: Column) -> Column:
    return F.regexp_extract(name, r"[/:]([12])$", 1)


def iupac_code(bases: Column) -> Column:
    """The ambiguity code of an array of bases; one base stands for itself."""
    key = F.array_join(F.array_sort(F.array_distinct(bases)), "")
    table = F.create_map(*[F.lit(x) for pair in AMBIGUITY.items() for x in pair])
    return F.when(F.length(key) == 1, key).otherwise(F.try_element_at(table, key))


def cigar_blocks(pos: Column, cigar: Column) -> Column:
    """Aligned blocks of a CIGAR as array<struct<lend, rend>>, 1-based and inclusive. M, = and X align; D, N skip on the genome and part blocks; insertions and clips take no place."""
    ops = F.regexp_extract_all(cigar, F.lit(r"(\d+)([MIDNSHP=X])"), 0)
    steps = F.transform(ops, lambda o: F.struct(F.regexp_extract(o, r"^(\d+)", 1).cast("int").alias("n"), F.substring(o, -1, 1).alias("op")))
    start = F.struct(pos.cast("int").alias("at"), F.array().cast("array<struct<lend:int,rend:int>>").alias("blocks"))

    def step(acc: Column, s: Column) -> Column:
        aligned, skipped = s["op"].isin("M", "=", "X"), s["op"].isin("D", "N")
        block = F.array(F.struct(acc["at"].alias("lend"), (acc["at"] + s["n"] - 1).alias("rend")))
        return F.struct(F.when(aligned | skipped, acc["at"] + s["n"]).otherwise(acc["at"]).alias("at"), F.when(aligned, F.concat(acc["blocks"], block)).otherwise(acc["blocks"]).alias("blocks"))

    return F.aggregate(steps, start, step, lambda acc: acc["blocks"])


def merge_short_gaps(blocks: Column, most: int = 5) -> Column:
    """Blocks with gaps of at most ``most`` positions between them joined."""
    empty = F.array().cast("array<struct<lend:int,rend:int>>")

    def step(acc: Column, b: Column) -> Column:
        last = F.element_at(acc, -1)
        joined = F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(last["lend"].alias("lend"), b["rend"].alias("rend"))))
        return F.when((F.size(acc) > 0) & (b["lend"] - last["rend"] - 1 <= most), F.when(F.size(acc) > 0, joined)).otherwise(F.concat(acc, F.array(b)))

    return F.aggregate(blocks, empty, lambda acc, b: F.when(F.size(acc) == 0, F.array(b)).otherwise(step(acc, b)))


def genome_span(blocks: Column) -> tuple[Column, Column]:
    return F.array_min(F.transform(blocks, lambda b: b["lend"])), F.array_max(F.transform(blocks, lambda b: b["rend"]))


def overlaps(a_lend: Column, a_rend: Column, b_lend: Column, b_rend: Column) -> Column:
    return (a_lend <= b_rend) & (a_rend >= b_lend)


def contains(a_lend: Column, a_rend: Column, b_lend: Column, b_rend: Column) -> Column:
    return (a_lend <= b_lend) & (a_rend >= b_rend)


def overlap_length(a_lend: Column, a_rend: Column, b_lend: Column, b_rend: Column) -> Column:
    return F.greatest(F.lit(0), F.least(a_rend, b_rend) - F.greatest(a_lend, b_lend) + 1)


def mismatches(a: Column, b: Column) -> Column:
    """Differing places of two sequences laid side by side from the left; what sticks out isn't counted."""
    n = F.least(F.length(a), F.length(b))
    pairs = F.zip_with(F.split(F.substring(a, F.lit(1), n), ""), F.split(F.substring(b, F.lit(1), n), ""), lambda x, y: (x != y).cast("int"))
    return F.when(n > 0, F.aggregate(pairs, F.lit(0), lambda s, x: s + x)).otherwise(0)


def zipper(a: Column, b: Column) -> Column:
    """The better of two ungapped alignments, anchored left or right (a tie: right): struct<side, matches, mismatches>."""
    n = F.least(F.length(a), F.length(b))
    left, right = mismatches(a, b), mismatches(F.reverse(a), F.reverse(b))
    pick = lambda side, m: F.struct(F.lit(side).alias("side"), (n - m).alias("matches"), m.alias("mismatches"))
    return F.when(left < right, pick("left", left)).otherwise(pick("right", right))


def percent_identity(matches: Column, mismatched: Column) -> Column:
    """matches / (matches + mismatches) * 100, two decimals."""
    return F.round(matches / (matches + mismatched) * 100, 2)


#: SQL definitions of functions for use in SQL text.
SQL_DEFINITIONS = {
    "revcomp": f"(s STRING) RETURNS STRING RETURN reverse(translate(s, '{IUPAC}', '{IUPAC_COMPLEMENT}'))",
    "canonical_kmer": f"(s STRING) RETURNS STRING RETURN least(s, reverse(translate(s, '{IUPAC}', '{IUPAC_COMPLEMENT}')))",
    "shannon_entropy": "(s STRING) RETURNS DOUBLE RETURN CASE WHEN length(s) > 0 THEN " + " + ".join(f"CASE WHEN length(s) > length(replace(s, '{b}', '')) THEN -((length(s) - length(replace(s, '{b}', ''))) / length(s)) * log2((length(s) - length(replace(s, '{b}', ''))) / length(s)) ELSE 0.0D END" for b in PACKED) + " ELSE 0.0D END",
    "cigar_span": "(p INT, c STRING) RETURNS STRUCT<lend: INT, rend: INT> RETURN named_struct('lend', p, 'rend', p - 1 + aggregate(regexp_extract_all(c, '(\\\\d+)[MDN=X]', 1), 0, (a, n) -> a + int(n)))",
    "core_read_name": "(s STRING) RETURNS STRING RETURN regexp_replace(s, '[/:][12]$', '')",
    "only_bases": "(s STRING) RETURNS BOOLEAN RETURN s RLIKE '^[ACGTacgt]+$'",
}


_CODONS = ", ".join(f"'{c}', '{a}'" for c, a in codon_table().items())
SQL_DEFINITIONS["translate_dna"] = f"(s STRING) RETURNS STRING RETURN CASE WHEN length(s) >= 3 THEN array_join(transform(regexp_extract_all(upper(s), '...', 0), c -> coalesce(map({_CODONS})[c], 'X')), '') ELSE '' END"


def register(spark) -> list[str]:
    """Registers the functions for use in SQL text; gives their names."""
    for name, body in SQL_DEFINITIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name} {body}")
    return list(SQL_DEFINITIONS)
