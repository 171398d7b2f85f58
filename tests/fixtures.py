"""Small hand-made inputs, written as text into a test folder."""

from __future__ import annotations

import hashlib

import numpy as np

# The hand-derived counts of the small study and the matrix they merge to.
GENES = ["gene_A.1", "gene_B.2", "gene_C", "gene_zero"]
RUN_COUNTS = {
    "run_c1a": [2, 3, 0, 0],
    "run_c1b": [4, 5, 1, 0],
    "run_c2": [8, 9, 2, 0],
    "run_t1": [18, 2, 6, 0],
    "run_t2": [20, 4, 7, 0],
}
RUN_SAMPLE = {"run_t2": "treated_2", "run_c1a": "control_1", "run_c1b": "control_1", "run_t1": "treated_1", "run_c2": "control_2"}
SAMPLE_ORDER = ["treated_2", "control_1", "treated_1", "control_2"]
EXPECTED = {"gene_A.1": [20, 6, 18, 8], "gene_B.2": [4, 8, 2, 9], "gene_C": [7, 1, 6, 2], "gene_zero": [0, 0, 0, 0]}


def tsv(rows) -> str:
    return "".join("\t".join(map(str, r)) + "\n" for r in rows)


def write(folder, name, text):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text if isinstance(text, bytes) else text.encode())
    return str(path)


def small_study(folder, mixed: bool = False) -> dict[str, str]:
    """Four samples, five technical runs, four genes; optionally in all three count formats."""
    paths = {
        "samples": write(folder, "samples.tsv", tsv([("sample_id", "condition")] + [(s, s.split("_")[0]) for s in SAMPLE_ORDER])),
        "runs": write(
            folder, "runs.tsv",
            tsv([("run_id", "sample_id", "fastq_1", "fastq_2", "layout", "strandedness")]
                + [(r, s, f"{r}_1.fq", f"{r}_2.fq" if s == "control_1" else "", "paired" if s == "control_1" else "single", "unstranded")
                   for r, s in RUN_SAMPLE.items()]),
        ),
        "genes": write(folder, "genes.tsv", tsv([("gene_id",)] + [(g,) for g in reversed(GENES)])),
        "annotation": write(
            folder, "annotation.tsv",
            tsv([("gene_id", "gene_symbol", "biotype", "chromosome"), ("gene_A.1", "SHARED", "protein_coding", "chr1"), ("gene_B.2", "SHARED", "", "chr1")]),
        ),
    }
    inputs = [("run_id", "format", "path", "column")]
    for run, counts in RUN_COUNTS.items():
        pairs = list(zip(GENES, counts))[::-1]
        if mixed and run == "run_c1a":
            write(folder, f"counts/{run}.txt", tsv(pairs))
            inputs.append((run, "legacy", f"counts/{run}.txt", ""))
        elif mixed and run == "run_c1b":
            head = ("Geneid", "Chr", "Start", "End", "Strand", "Length", "unused.bam", "mine.bam")
            body = [(g, "1", "1", "9", "+", "9", 99, c) for g, c in pairs]
            write(folder, f"counts/{run}.tab", "# made by hand\n" + tsv([head] + body))
            write(folder, f"counts/{run}.tab.summary", tsv([("Status", "unused.bam", "mine.bam"), ("Assigned", 396, 10), ("Unassigned_Unmapped", 0, 2)]))
            inputs.append((run, "featurecounts", f"counts/{run}.tab", "mine.bam"))
        else:
            write(folder, f"counts/{run}.tsv", tsv([("gene_id", "count")] + pairs))
            inputs.append((run, "tsv", f"counts/{run}.tsv", ""))
    paths["inputs"] = write(folder, "inputs.tsv", tsv(inputs))
    return paths


def bundle(folder) -> dict[str, str]:
    paths = small_study(folder)
    files = {"genome": b">chr1\nACGT\n", "annotation": b"chr1\tx\texon\t1\t4\n"}
    rows = [("role", "path", "sha256", "source", "release")]
    for role, content in files.items():
        write(folder, f"{role}.txt", content)
        rows.append((role, f"{role}.txt", hashlib.sha256(content).hexdigest().upper(), "made", "r1"))
    paths["references"] = write(folder, "references.tsv", tsv(rows))
    paths["settings"] = write(
        folder, "analysis.tsv",
        tsv([("key", "value"), ("version", 1), ("design_terms", "condition"), ("alpha", 0.05), ("filter", "zero_total"), ("shrinkage", "apeglm")]),
    )
    paths["contrasts"] = write(
        folder, "contrasts.tsv", tsv([("contrast_id", "factor", "numerator", "denominator"), ("treated_vs_control", "condition", "treated", "control")])
    )
    return paths


GENE_COUNT, SAMPLE_COUNT = 1_000, 8
UP, DOWN, EMPTY, SPARSE = range(0, 80), range(80, 160), 499, range(600, 960)


def simulated_counts(seed: int = 21) -> np.ndarray:
    """Genes x samples with what the model tests look for: fourfold changes either way in the second half of the samples,
    a batch that alternates and moves a third of the genes, sparse genes, and one gene without any count.

    Expression and dispersion vary by gene, so trends and filters have something to find.
    """
    rng = np.random.default_rng(seed)
    level = np.exp(rng.normal(5.0, 1.0, GENE_COUNT))
    level[SPARSE] = 0.4
    dispersion = 0.02 + 0.5 / (1.0 + level) * rng.uniform(0.5, 1.5, GENE_COUNT)
    late = (np.arange(SAMPLE_COUNT) >= SAMPLE_COUNT // 2).astype(float)
    odd = np.arange(SAMPLE_COUNT) % 2
    change = np.zeros(GENE_COUNT)
    change[UP], change[DOWN] = 2.0, -2.0
    shift = np.where(rng.random(GENE_COUNT) < 1 / 3, 0.7, 0.0)
    mean = level[:, None] * 2.0 ** (change[:, None] * late + shift[:, None] * odd)
    rate = rng.gamma(1.0 / dispersion[:, None], dispersion[:, None] * mean)
    counts = rng.poisson(rate)
    silent = np.flatnonzero(counts.sum(axis=1) == 0)
    counts[silent, silent % SAMPLE_COUNT] = 1
    counts[EMPTY] = 0
    return counts
