from helixframe.functions.bases import (contig_style, error_prob, phred_decode, phred_encode,
                                        quality_sum, reverse_complement)
from helixframe.functions.cigar import (aligned_blocks, aligned_length, cigar_ops, indels, introns, leading_clip,
                                        query_length, ref_length, reference_runs, trailing_clip, unclipped_5p)
from helixframe.functions.flags import FLAG_BITS, has_all, has_none, sam_flag_is

__all__ = [
    "FLAG_BITS", "aligned_blocks", "aligned_length", "cigar_ops", "contig_style", "error_prob", "has_all",
    "has_none", "indels", "introns", "leading_clip", "phred_decode", "phred_encode", "quality_sum", "query_length",
    "ref_length", "reference_runs", "reverse_complement", "sam_flag_is", "trailing_clip", "unclipped_5p",
]
