"""Column functions on captions, names and log lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The 29 white-space code points of the caption contract.
WHITE = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_NOT_SPACE = r"\t-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def whitespace_problem(text: Column) -> Column:
    """What is wrong with a caption's white space, or null.  In this order: at an edge; two ASCII spaces in a row;
    the first other white space, by its code point."""
    other = F.regexp_extract(text, f"([{_NOT_SPACE}])", 1)
    # the code point of a character of the BMP: its two UTF-16 bytes
    point = F.concat(F.lit("U+"), F.hex(F.encode(other, "UTF-16BE")))
    return (
        F.when(text.rlike(rf"\A[{WHITE}]|[{WHITE}]\z"), F.lit("leading or trailing whitespace"))
        .when(F.contains(text, F.lit("  ")), F.lit("repeated ASCII spaces"))
        .when(other != "", F.concat(F.lit("unexpected whitespace "), point))
    )


def caption_problem(text: Column) -> Column:
    """Null, empty or badly spaced captions."""
    return F.when(text.isNull(), F.lit("not a string")).when(text == "", F.lit("empty")).otherwise(whitespace_problem(text))


def problem_free(text: Column) -> Column:
    """Whether a text is there and not only white space."""
    return F.coalesce(~text.rlike(rf"\A[{WHITE}]*\z"), F.lit(False))


def replaced(text: Column, pairs: dict[str, str]) -> Column:
    """The replacement of a text that matches exactly, else the text."""
    if not pairs:
        return text
    table = F.create_map(*(F.lit(x) for kv in pairs.items() for x in kv))
    return F.coalesce(F.element_at(table, text), text)


def replaced_list(texts: Column, pairs: dict[str, str]) -> Column:
    return F.transform(texts, lambda t: replaced(t, pairs))


def replaced_blocks(blocks: Column, pairs: dict[str, str], field: str = "sub_task_instruction") -> Column:
    return F.transform(blocks, lambda b: b.withField(field, replaced(b[field], pairs)))


def safe_name(name: Column) -> Column:
    return F.coalesce(name.rlike(r"\A[A-Za-z0-9][A-Za-z0-9._-]*\z"), F.lit(False))


def commit_hash(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\A[0-9a-f]{40}\z"), F.lit(False))


def ssh_target(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\A[A-Za-z0-9_][A-Za-z0-9_.-]*@[A-Za-z0-9][A-Za-z0-9.-]*\z"), F.lit(False))


def number_after(text: Column, prefix: str) -> Column:
    """N of `prefix`N at the end of a path or name, else null."""
    return F.regexp_extract(text, rf"(?:\A|/){prefix}(\d+)\z", 1).try_cast("long")


def episode_name(episode: Column) -> Column:
    return F.format_string("episode_%06d", episode)


def portable_path(path: Column, workspace: str) -> Column:
    root = workspace.rstrip("/")
    return F.when(path == root, F.lit("${workspace}")).when(F.startswith(path, F.lit(root + "/")), F.concat(F.lit("${workspace}"), F.substring(path, len(root) + 1, 1 << 30))).otherwise(path)


def contains_ignoring_case(text: Column, part: Column) -> Column:
    return F.contains(F.lower(text), F.lower(part))


def fraction(text: Column) -> Column:
    """"15/1" as a double; a zero denominator is an error."""
    parts = F.split(text, "/")
    return parts[0].cast("double") / F.coalesce(F.get(parts, F.lit(1)).cast("double"), F.lit(1.0))


def exit_code(code: Column) -> Column:
    """A child ended by signal n reports -n: as 128 + n."""
    return F.when(code >= 0, code).otherwise(128 - code)


def is_close(a: Column, b: Column, relative: float = 1e-9) -> Column:
    return F.abs(a - b) <= F.greatest(F.abs(a), F.abs(b)) * relative


def utc_stamp(ts: Column, compact: bool = False) -> Column:
    return F.date_format(ts, "yyyyMMdd'T'HHmmss'Z'" if compact else "yyyy-MM-dd'T'HH:mm:ss'Z'")


def gibibytes(size: Column) -> Column:
    return size / F.lit(float(1 << 30))


#: One number as log lines print it, and fixed values: a trainer's step line, and its last summary where it prints no steps.
_NUMBER = r"([-+0-9.eE]+)"
STEP_LINE = rf"\bstep:(\d+).*?\bloss:{_NUMBER}.*?\bgrdn:{_NUMBER}.*?\bsmp/s:{_NUMBER}.*?\bmem_gb:{_NUMBER}"
METRICS = {"step": "long", "loss": "double", "gradient_norm": "double", "samples_per_second": "double", "cuda_memory_gib": "double"}
SUMMARY = {"loss": rf"'train_loss':\s*{_NUMBER}", "samples_per_second": rf"'train_samples_per_second':\s*{_NUMBER}"}


def step_metrics(line: Column) -> Column:
    """A struct of the metrics of the last complete step report in a line, else null: one match, then a split."""
    found = F.when(F.contains(line, F.lit("mem_gb:")), F.get(F.regexp_extract_all(line, F.lit(f".*({STEP_LINE})"), F.lit(1)), F.lit(0)))
    parts = F.split(F.regexp_replace(found, rf"\A{STEP_LINE}\z", "$1|$2|$3|$4|$5"), r"\|")
    whole = F.struct(*(F.get(parts, F.lit(k)).try_cast(kind).alias(name) for k, (name, kind) in enumerate(METRICS.items())))
    return F.when(found.isNotNull(), whole)


def summary_metric(line: Column, name: str) -> Column:
    """The last value of a summary's metric in a line, else null."""
    pattern = SUMMARY[name]
    return F.when(F.contains(line, F.lit("'train_")), F.get(F.regexp_extract_all(line, F.lit(f".*{pattern}"), F.lit(1)), F.lit(0)).try_cast("double"))


#: What a log says when memory ran out.
OUT_OF_MEMORY = r"(?i)CUDA out of memory|OutOfMemoryError|CUBLAS_STATUS_ALLOC_FAILED"


def failure_category(code: Column, timed_out: Column, log: Column) -> Column:
    """Null for exit 0, whatever else; then timeout before oom before signal (codes from 128) before trainer_error."""
    oom = F.coalesce(log.rlike(OUT_OF_MEMORY), F.lit(False))
    return F.when(code == 0, F.lit(None)).when(timed_out, F.lit("timeout")).when(oom, F.lit("oom")).when(code >= 128, F.lit("signal")).otherwise(F.lit("trainer_error"))


def device_inode(text: Column) -> Column:
    """Whether a text names a device and inode, as `stat` prints them."""
    return F.coalesce(text.rlike(r"\A[0-9]+:[0-9]+\z"), F.lit(False))


def whole_number(text: Column) -> Column:
    """A value as a whole number as far as it is one: numbers are cut off at the point, texts must be digits; else null."""
    return text.try_cast("long")


def enough_space(free_bytes: Column, least_gib: Column) -> Column:
    return gibibytes(free_bytes) >= least_gib
