"""Record schemas of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

from .functions.accession import TYPED_COLUMNS


def strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


RECORD_V1 = strings("pubmed_id", "source_sheet", "isolate_name", "accession", "accession_type", "organism", "drug_raw", "mic_operator", "mic_value", "sir_call")
RECORD_INNER = strings("isolate_id", "accession", "drug", "mic_sign", "mic", "sir_call", "notes")
RECORD_FINAL = strings("pmid", "file_name", "sheet_name", "isolate_id", *TYPED_COLUMNS, "drug", "mic_sign", "mic", "sir_call", "notes")
METADATA = strings("isolate_id", "accession", "secondary_accession")
TRUTH_ACCESSIONS = ("genome.biosample_accession", "genome.assembly_accession", "genome.genbank_accessions", "genome.refseq_accessions", "genome.sra_accession")
TRUTH = strings("genome_id", "antibiotic", "resistant_phenotype", "measurement_sign", "measurement_value", *TRUTH_ACCESSIONS)
SAMPLE = strings("bioproject_accession", "biosample_uid", "biosample_accession", "strain", "sra_accession")
MATCH = strings("pmid", "source_file", "isolate_id", "match_type", "matched_strain", "bioproject_accession", "biosample_accession", "sra_accession")
METRIC = strings("Section", "Metric", "Value")
CLASSIFICATION = "sheet_name STRING, contains_ast_data BOOLEAN, has_mic_values BOOLEAN, has_sir_calls BOOLEAN, reasoning STRING"
COLUMN_MAP = "sheet_name STRING, columns ARRAY<STRUCT<column_name: STRING, role: STRING, drug_name: STRING, paired_with: STRING>>, header_row_index INT, reasoning STRING"
COLUMN_ROLES = ("local_id", "public_accession", "organism", "drug_mic", "drug_sir", "drug_mic_and_sir", "metadata", "skip")
CELLS = "pmid STRING, file_name STRING, sheet_name STRING, row_idx INT, col_idx INT, value STRING, is_string BOOLEAN"
PAPER = (
    "pmid STRING, title STRING, first_author STRING, year STRING, pmcid STRING, doi STRING, ast_location STRING, biosample_hint STRING, details STRING, "
    "genome_ids ARRAY<STRING>, bvbrc_genome_ids ARRAY<STRING>, supplement_files ARRAY<STRING>, data_availability_accessions ARRAY<STRING>, notes ARRAY<STRING>"
)
