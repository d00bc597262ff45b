"""Text sinks. Rows are range-sorted, so the part files in name order are the ordered file."""
from helixframe.sinks.text import (write_bedgraph, write_fastq, write_gff3, write_sam, write_vcf)

__all__ = ["write_bedgraph", "write_fastq", "write_gff3", "write_sam", "write_vcf"]
