"""Text mining: gazetteer mentions with exact offsets, sentence context, polarity and disease context.

Matching text against a vocabulary is sequential and needs offsets, so it runs in an Arrow function
over distinct texts; everything after it (which sentence, which trigger, which role) is columns.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions import scalars as S
from lodestone.runtime import sorted_side

# Whole-field and per-mention ignore terms, in matching form.
IGNORED = (
    "product used for unknown indication", "drug use unknown indication", "off label use", "prophylaxis", "ill defined disorder", "premedication",
    "product use in unapproved indication", "intentional product misuse", "exposure during pregnancy", "foetal exposure during pregnancy", "product origin unknown",
    "accidental exposure to product", "product use issue", "unknown indication", "unknown indcation", "product administration",
)
# Whole-word synonyms that may be switched on.
SYNONYMS = {"cardiac": "heart", "renal": "kidney", "hepatic": "liver"}
# Patterns of sentence context (searched without regard to case).
KEYWORDS = (
    r"\b(contraindicat\w*|should\s+not\s+be\s+used|must\s+not\s+(?:be\s+)?used|do\s+not\s+use|not\s+recommended|avoid\s+(?:use\s+)?in|prohibit\w*|"
    r"must\s+avoid|use\s+is\s+contraindicat\w*|not\s+for\s+use\s+in)\b"
)
HARD = r"\b(?:contraindicat\w*|do\s+not\s+use|must\s+not\s+(?:be\s+)?used|should\s+not\s+be\s+used|not\s+for\s+use\s+in|never\s+(?:give|use)|prohibit\w*)\b"
NEGATION = (
    r"\b(?:not|never)\s+(?:be\s+)?contraindicat\w*\b|\b(?:no|none|without)\s+(?:known\s+)?contraindications?\b|\bnone\s+known\b|\bnone\s*(?:[.;!?]|$)"
)
SOFT = r"\b(?:avoid(?:\s+use)?|not\s+recommended|use\s+with\s+caution|warning|precaution|monitor(?:ing)?|consider\s+an\s+alternative)\b"
PATIENTS = r"\b(?:in|among|for)\s+(?:patients?|people|individuals|subjects|persons|those)\s+(?:with|having|who\s+(?:have|has))\b"
INTRO = r"\b(?:for\s+(?:the\s+)?(?:treatment|management)\s+of|(?:when|if)\s+(?:used|given|administered)\s+(?:for|to\s+treat)|used\s+in\s+the\s+treatment\s+of)\b"
MEDICATION = r"\b(?:receiving|taking|administered\s+with|co[- ]?administered|concomitant|concurrent\s+(?:use|therapy)|drug[- ]drug\s+interaction)\b"
SECTION_KINDS = {"34067-9": "indications", "34070-3": "contraindications", "34066-1": "boxed_warning", "34071-1": "warnings", "43685-7": "warnings"}
NEEDS_HARD = ("indications", "boxed_warning", "warnings")
MENTION = "struct<text:string,start:int,end:int,type:string,score:double,normalized:string,notes:string>"
EXACT_SCORE, SYNONYM_SCORE = 1.0, 0.9


def folded(text: str) -> str:
    """The matching form of a term: see scalars.normalize_text."""
    bare = re.sub(r"<[^>]*>", " ", text.lower()).replace("'s", " ")
    return " ".join(re.sub(r"[^a-z0-9]+", " ", bare).split())


_TOKENS = re.compile(r"<[^>]*>|(?:'[sS])*((?:[A-Za-z0-9\u212a]+(?:'[sS])*)+)|'[sS]")


def tokens_with_offsets(text: str) -> list[tuple[str, int, int]]:
    """Words of the matching form with their range in the text; markup breaks words.

    A possessive `'s` vanishes without ending the word, so that a word may span it.
    """
    out: list[tuple[str, int, int]] = []
    for m in _TOKENS.finditer(text):
        if (word := m[1]) is not None:
            start, end = m.span(1)
            if "'" in word:
                bare = word
                while bare[-2:] in ("'s", "'S"):
                    bare, end = bare[:-2], end - 2
                word = bare.replace("'s", "").replace("'S", "")
            out.append((word.lower(), start, end))
    return out


class Gazetteer:
    """Terms to types, matched longest first on whole words, without overlaps."""

    def __init__(self, terms: Mapping[str, str], ignored: Sequence[str] = IGNORED, synonyms: Mapping[str, str] | None = None):
        self.types: dict[tuple[str, ...], str] = {}
        for term, kind in terms.items():
            if key := tuple(folded(term).split()):
                self.types.setdefault(key, kind)
        self.by_first: dict[str, list[tuple[str, ...]]] = {}
        for key in self.types:
            self.by_first.setdefault(key[0], []).append(key)
        self.ignored = {folded(t) for t in ignored}
        self.synonyms = {folded(k): folded(v).split() for k, v in (synonyms or {}).items()}

    def match(self, text: str | None) -> list[dict]:
        """Mentions in the text's order; a text that is an ignored term as a whole has none.

        Candidates are taken by length of the term, then by term, then by place. An ignored mention
        is not returned but still blocks what it covers.
        """
        if not text or folded(text) in self.ignored:
            return []
        words: list[tuple[str, int, int, str]] = []
        for w, a, b in tokens_with_offsets(text):
            swap = self.synonyms.get(w)
            words += [(x, a, b, f"synonym:{w}>{' '.join(swap)}") for x in swap] if swap and swap != [w] else [(w, a, b, "")]
        found = []
        for i, (w, *_rest) in enumerate(words):
            for key in self.by_first.get(w, ()):
                if all(i + k < len(words) and words[i + k][0] == part for k, part in enumerate(key)):
                    found.append((-len(" ".join(key)), " ".join(key), i, key))
        taken, out = [False] * len(words), []
        for _, _, i, key in sorted(found):
            span = range(i, i + len(key))
            if any(taken[k] for k in span):
                continue
            for k in span:
                taken[k] = True
            a, b = words[i][1], words[i + len(key) - 1][2]
            surface = folded(text[a:b])
            if surface not in self.ignored:
                notes = sorted({words[k][3] for k in span if words[k][3]})
                out.append({"text": text[a:b], "start": a, "end": b, "type": self.types[key], "score": SYNONYM_SCORE if notes else EXACT_SCORE, "normalized": surface, "notes": ";".join(notes) or "exact"})
        return sorted(out, key=lambda m: (m["start"], m["end"], m["type"], m["text"]))


Predictor = Callable[[str], Sequence[Mapping]]
# The built-in vocabulary of conditions, diseases before findings.
CLINICAL_TERMS = dict.fromkeys((
    "asthma", "liver disease", "active liver disease", "heart failure", "severe heart failure", "myocardial infarction", "peptic ulcer", "peptic ulcer disease", "renal impairment", "severe renal impairment",
    "renal disease", "end stage renal disease", "hypertension", "uncontrolled hypertension", "arrhythmia", "ventricular arrhythmias", "stroke", "hemorrhagic stroke", "hepatic impairment", "severe hepatic impairment",
    "epilepsy", "glaucoma", "narrow angle glaucoma", "hypercholesterolemia", "diabetes mellitus", "type 2 diabetes mellitus", "chronic obstructive pulmonary disease", "atrial fibrillation", "arthritis",
    "rheumatoid arthritis", "depression", "migraine", "congestive heart failure", "cirrhosis", "hepatic encephalopathy", "acute kidney injury", "hepatocellular carcinoma",
), "disease") | dict.fromkeys((
    "hypersensitivity", "transaminase elevations", "bleeding", "active bleeding", "gastrointestinal bleeding", "pregnancy", "qt prolongation", "seizure", "seizures", "headache", "pain", "back pain", "nausea",
    "vomiting", "fatigue",
), "phenotype")
# Words without clinical meaning that are trimmed off a model span's start, and spans that name people.
HEDGES = frozenset((
    "a", "an", "the", "any", "all", "some", "other", "certain", "this", "these", "those", "of", "with", "in", "to", "and", "or", "for", "on", "at", "recent", "recently", "prior", "previous", "previously", "history",
    "known", "suspected", "possible", "potential", "current", "currently", "ongoing", "documented", "existing", "preexisting", "underlying", "patient", "patients", "women", "men", "children", "individuals", "subjects",
))
POPULATION = frozenset((
    "women", "men", "children", "patients", "individuals", "subjects", "women of childbearing potential", "childbearing potential", "women of childbearing age", "pregnant women",
))
SPAN_WORDS = re.compile(r"\w+(?:[-_]\w+)*|\S")


def default_recogniser(terms: Mapping[str, str] | None = None) -> Gazetteer:
    """The recogniser without a model: the given terms with their types, else the built-in vocabulary."""
    return Gazetteer(CLINICAL_TERMS if terms is None else terms)


def mined(texts: DataFrame, text: str, miner: Callable[[str], list[dict]], column: str = "mentions") -> DataFrame:
    """texts with the mentions a miner finds, each distinct text mined once; null texts have none.

    The miner is shipped to the workers: a Gazetteer's match, a merged model or any function of text
    that returns mention dicts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("text", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("type", pa.string()), ("score", pa.float64()), ("normalized", pa.string()), ("notes", pa.string())]))
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([miner(t) for t in b.column(0).to_pylist()], kind)], names=["__t", "__m"])

    one = texts.select(F.col(text).alias("__t")).where("__t is not null").distinct()
    hits = one.mapInArrow(run, f"__t string, __m array<{MENTION}>")
    return texts.join(sorted_side(hits), F.col(text) == F.col("__t"), "left").withColumn(column, F.coalesce("__m", F.array().cast(f"array<{MENTION}>"))).drop("__t", "__m")


def mined_with_cache(texts: DataFrame, text: str, miner: Callable[[str], list[dict]], config: str, cache: str, column: str = "mentions") -> DataFrame:
    """mined(), keeping results in a parquet table by content: only texts it lacks are mined and appended.

    The key holds the text (white space collapsed) and `config`, the miner's own fingerprint. Each call
    adds a folder of its own, which appears under the cache when it is complete; nothing is rewritten.
    """
    spark = texts.sparkSession
    key = S.stable_id(F.lit(config), S.collapse_ws(F.col(text)), prefix="")
    asked = texts.select(key.alias("key"), F.col(text).alias("t")).where("t is not null").groupBy("key").agg(F.min("t").alias("t"))
    schema = f"key string, mentions array<{MENTION}>"
    jvm = spark.sparkContext._jvm
    at = lambda p: jvm.org.apache.hadoop.fs.Path(p)
    fs = at(cache).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def stored() -> DataFrame:
        done = [f"{cache}/{s.getPath().getName()}" for s in fs.listStatus(at(cache))] if fs.exists(at(cache)) else []
        done = [p for p in done if not p.rpartition("/")[2].startswith((".", "_"))]
        return spark.read.schema(schema).parquet(*done) if done else spark.createDataFrame([], schema)

    missing = asked.join(stored().select("key"), "key", "left_anti")
    name = uuid.uuid4().hex
    mined(missing, "t", miner).select("key", "mentions").write.parquet(f"{cache}/.{name}")
    fs.rename(at(f"{cache}/.{name}"), at(f"{cache}/{name}"))
    stored = stored().groupBy("key").agg(F.min("mentions").alias("mentions")).select(F.col("key").alias("__key"), F.col("mentions").alias(column))
    return texts.withColumn("__k", key).join(stored, F.col("__k") == F.col("__key"), "left").drop("__k", "__key").withColumn(column, F.coalesce(column, F.array().cast(f"array<{MENTION}>")))


def regex_mentions(normalized: Column, terms: Sequence[str]) -> Column:
    """Terms found in normalised text as an array, without Python: longest first, whole words."""
    alternatives = "|".join(re.escape(t) for t in sorted({folded(t) for t in terms} - {""}, key=lambda t: (-len(t), t)))
    return F.regexp_extract_all(normalized, F.lit(rf"\b(?:{alternatives})\b"), F.lit(0))


class ModelMiner:
    """Merges a span model's predictions with a gazetteer's mentions.

    `predict(text)` yields spans (start, end, label, score). Long texts go through windows of whole
    sentences up to `budget` words, longer sentences are cut; spans cut there are rejoined. Spans of
    population words or other labels go, leading hedges are trimmed. A model span that equals, cuts
    or covers several gazetteer spans gives way to them, one around a single gazetteer span replaces
    it with the gazetteer's type. Below `floor` such a pair yields nothing: the specific reading is
    unsure and the general one superseded.
    """

    LABELS = {"disease", "phenotype"}

    def __init__(self, predict: Predictor, gazetteer: Gazetteer, floor: float = 0.5, budget: int = 300):
        self.predict, self.gazetteer, self.floor, self.budget = predict, gazetteer, floor, budget

    def windows(self, text: str) -> Iterator[tuple[int, str]]:
        """(offset, piece): whole sentences packed up to the budget, sentences over it cut between words."""
        start = end = words = 0
        for m in re.finditer(r"[^.!?;]*(?:[.!?;]+(?:\s+|\Z)|[.!?;](?=\S)|\Z)", text, re.S):
            if not m[0]:
                continue
            n = len(m[0].split())
            if words and words + n > self.budget:
                yield start, text[start:end]
                start, words = m.start(), 0
            if n > self.budget:
                at = list(re.finditer(r"\S+\s*", m[0]))
                for k in range(0, len(at), self.budget):
                    part = at[k : k + self.budget]
                    yield m.start() + part[0].start(), m[0][part[0].start() : part[-1].end()]
                start, words = m.end(), 0
            else:
                words += n
            end = m.end()
        if start < end:
            yield start, text[start:end]

    def _trimmed(self, text: str, a: int, b: int) -> tuple[int, int] | None:
        """The span from its first word that is no hedge on; None if there is none or it names people."""
        for m in SPAN_WORDS.finditer(text, a, b):
            if folded(m[0]) not in HEDGES:
                a = m.start() if any(folded(w[0]) in HEDGES for w in SPAN_WORDS.finditer(text, a, m.start())) else a
                return None if folded(text[a:b]) in POPULATION else (a, b)
        return None

    def _spans(self, text: str) -> list[tuple[int, int, str, float]]:
        """The model's spans of disease and finding, rejoined where a window cut them, hedges trimmed."""
        out: list[tuple[int, int, str, float]] = []
        open_, last_end = None, None  # a span that ends flush with its window, and that window's end
        for offset, piece in self.windows(text):
            own = []
            for p in self.predict(piece):
                kind = S.TYPE_ALIASES.get(str(p["label"]).strip().lower(), str(p["label"]).strip().lower())
                a, b = offset + p["start"], offset + p["end"]
                if kind in self.LABELS and folded(text[a:b]) not in POPULATION:
                    own.append((a, b, kind, float(p["score"])))
            # only cuts between words leave a gap between windows; a span on both sides of it is one
            first = next((s for s in own if s[0] == offset), None)
            if open_ is not None and first is not None and last_end is not None and last_end < offset and not text[last_end:offset].strip():
                out.remove(open_)
                own.remove(first)
                lead = open_ if open_[3] >= first[3] else first
                own.append((open_[0], first[1], lead[2], max(open_[3], first[3])))
            last_end = offset + len(piece.rstrip())
            open_ = next((s for s in reversed(own) if s[1] == last_end), None)
            out += own
        return [(*t, kind, score) for a, b, kind, score in out if (t := self._trimmed(text, a, b))]

    def __call__(self, text: str | None) -> list[dict]:
        if not text:
            return []
        base = self.gazetteer.match(text)
        able: list[tuple[int, int, str, float, list[int]]] = []
        for a, b, kind, score in self._spans(text):
            met = [k for k, m in enumerate(base) if a < m["end"] and m["start"] < b]
            inside = [k for k in met if a <= base[k]["start"] and base[k]["end"] <= b and (base[k]["start"], base[k]["end"]) != (a, b)]
            if len(met) == len(inside) <= 1:
                able.append((a, b, kind, score, inside))
        taken: list[tuple[int, int]] = []
        chosen: list[dict] = []
        gone: set[int] = set()
        for a, b, kind, score, inside in sorted(able, key=lambda s: (s[0] - s[1], -s[3], s[0], s[1], s[2])):
            if any(a < y and x < b for x, y in taken):
                continue
            gone.update(inside)
            taken.append((a, b))
            if score >= self.floor:
                chosen.append({"text": text[a:b], "start": a, "end": b, "type": base[inside[0]]["type"] if inside else kind, "score": score, "normalized": folded(text[a:b]), "notes": "model"})
        return sorted(chosen + [m for k, m in enumerate(base) if k not in gone], key=lambda m: (m["start"], m["end"], m["type"], m["text"]))


def balanced(texts: DataFrame, text: str, partitions: int) -> DataFrame:
    """Texts spread so that partitions hold like amounts of text: dealt out in turn by length.

    Lengths are ranked within hashed groups, so no task sees more than its share of the rows.
    """
    group = F.pmod(F.xxhash64(text), F.lit(partitions))
    turn = F.row_number().over(Window.partitionBy(group).orderBy(F.desc(F.length(text)), text))
    return texts.withColumn("__turn", F.pmod(turn + group, F.lit(partitions))).repartitionByRange(partitions, "__turn").drop("__turn")


def work_items(sections: DataFrame, singles: DataFrame, keywords: str = KEYWORDS) -> DataFrame:
    """Section texts to be mined: `(item_id, spl_set_id, doc_id, section_kind, text)` of labels with one active ingredient.

    Indication sections keep only sentences that the keywords find, joined by blanks.
    """
    kinds = F.create_map(*[F.lit(x) for kv in SECTION_KINDS.items() for x in kv])
    one = sections.join(sorted_side(singles.select("spl_set_id").distinct()), "spl_set_id", "left_semi").withColumn("section_kind", kinds[F.col("loinc_code")]).where("section_kind is not null")
    text = F.when(F.col("section_kind") == "indications", S.keyword_sentences(F.col("text"), "(?i)" + keywords)).otherwise(F.col("text"))
    return one.withColumn("text", text).where(F.btrim("text") != "")


def classified(items: DataFrame, item: Sequence[str], text: str = "text", mentions: str = "mentions", kind: str = "section_kind") -> DataFrame:
    """Each mention with its decision: accepted, trigger, evidence sentence and disease context.

    In order: a sentence that negates rejects; a mention before a medication marker in a sentence
    without a patient clause is treatment context; indication and warning sections need a hard
    prohibition; a hard prohibition accepts; in a contraindication section a sentence with only soft
    language rejects, any other accepts. Then per sentence with a patient clause: several mentions
    after it reject all of the sentence's; exactly one before and one after, the former introduced
    as treated, make the former the latter's context, unless it is no disease or medication is named.
    """
    rows = items.withColumn("__s", S.sentences(F.col(text))).select(*item, kind, text, "__s", F.posexplode_outer(mentions).alias("__i", "m")).where("m is not null")
    hit = F.get(F.filter("__s", lambda s: (F.col("m.start") < s["end"]) & (s["start"] < F.col("m.end"))), F.lit(0))
    rows = rows.withColumn("s", hit).withColumn("evidence", F.coalesce(F.col("s.text"), F.btrim(text)))
    e = F.col("evidence")
    find = lambda p: F.regexp_instr(e, F.lit("(?i)" + p)) - 1  # noqa: E731  (-1: not found)
    rows = rows.select(
        "*", (F.col("m.start") - F.coalesce("s.start", F.lit(0))).alias("a"), (F.col("m.end") - F.coalesce("s.start", F.lit(0))).alias("b"),
        find(PATIENTS).alias("p_at"), F.length(F.regexp_substr(e, F.lit("(?i)" + PATIENTS))).alias("p_len"), find(MEDICATION).alias("med_at"), find(INTRO).alias("intro_at"),
        F.length(F.regexp_substr(e, F.lit("(?i)" + INTRO))).alias("intro_len"), F.lower(F.regexp_substr(e, F.lit("(?i)" + HARD))).alias("hard"),
    )
    medication_only = (F.col("med_at") >= 0) & (F.col("p_at") < 0) & (F.col("b") <= F.col("med_at"))
    reason = (
        F.when(e.rlike("(?i)" + NEGATION), "explicit_negation").when(medication_only, "medication_only_context")
        .when(F.col(kind).isin(*NEEDS_HARD) & F.col("hard").isNull(), "no_hard_trigger").when(F.col("hard").isNotNull(), F.col("hard"))
        .when((F.col(kind) == "contraindications") & e.rlike("(?i)" + SOFT), "soft_safety_only").otherwise("contraindication_section")
    )
    rejected = ("explicit_negation", "medication_only_context", "no_hard_trigger", "soft_safety_only")
    rows = rows.withColumn("trigger", reason).withColumn("accepted", ~F.col("trigger").isin(*rejected))
    # roles within the sentence; a sentence's mentions are as few as its words
    w = Window.partitionBy(*item, F.col("s.start"))
    clause = F.col("p_at") >= 0
    before, after = clause & (F.col("b") <= F.col("p_at")), clause & (F.col("a") >= F.col("p_at") + F.col("p_len"))
    rows = rows.withColumn("n_before", F.count_if(before).over(w)).withColumn("n_after", F.count_if(after).over(w))
    paired = (F.col("n_before") == 1) & (F.col("n_after") == 1)
    introduced = (F.col("intro_at") >= 0) & (F.col("intro_at") + F.col("intro_len") <= F.col("p_at")) & (F.col("intro_at") + F.col("intro_len") <= F.col("a"))
    is_context = paired & before & introduced & (S.normalize_text(F.col("m.text")) != "")
    usable = is_context & (F.lower("m.type") == "disease") & (F.col("med_at") < 0)
    context = F.max(F.when(usable, S.normalize_text(F.col("m.text")))).over(w)
    ambiguous = clause & (F.col("n_after") > 1)
    trigger = (
        F.when(ambiguous, "ambiguous_patient_conjunction").when(is_context & (F.lower("m.type") != "disease"), "context_not_disease")
        .when(is_context & (F.col("med_at") >= 0), "context_only_medication").when(is_context, "context_only").otherwise(F.col("trigger"))
    )
    accepted = F.col("accepted") & ~ambiguous & ~is_context
    return rows.select(
        *item, kind, "m", accepted.alias("accepted"), trigger.alias("trigger"), e.alias("evidence_text"), F.when(accepted & paired & after, F.coalesce(context, F.lit(""))).otherwise("").alias("context_text")
    )
