"""End-to-end chains of the operators, on DataFrames and from files to files."""
from helixframe.plans.chains import (align_reads, call_cnvs, call_variants, preprocess_reads,
                                     preprocess_reads_with_known_indels)
from helixframe.plans.files import (align_files, call_cnvs_files, call_variants_files, preprocess_files,
                                    preprocess_files_with_known_indels)

__all__ = ["align_files", "align_reads", "call_cnvs", "call_cnvs_files", "call_variants", "call_variants_files",
           "preprocess_files", "preprocess_files_with_known_indels", "preprocess_reads", "preprocess_reads_with_known_indels"]
