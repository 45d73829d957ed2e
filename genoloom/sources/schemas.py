"""Schemas of the files that the pipeline's tools write."""

from __future__ import annotations

from pyspark.sql import types as T



# Layouts of the files.
DDL = {
    "distance": "g1_path string, g2_path string, dist double, p_value double, shared string",
    "blast_hit": "qseqid string, sseqid string, pident double, length int, mismatch int, gapopen int, qstart int, qend int, sstart int, send int, evalue double, bitscore double, stitle string",
    "assembly_summary": "assembly_accession string, bioproject string, biosample string, wgs_master string, refseq_category string, taxid string, species_taxid string, organism_name string",
    "family_pairs": "representative string, member string",
    "seed_orthologs": "query string, hit string, evalue double, score double, qstart int, qend int, sstart int, send int, pident double, qcov double, scov double",
    "taxonomy": "gcf string, taxid string, species_taxid string, organism_name string, kingdom string, phylum string, tax_class string, tax_order string, family string, genus string, species string",
    "pathway_links": "pathway_id string, gene_id string",
    "pathway_names": "pathway_id string, pathway_name string",
    "edges": "from string, to string, combined_score int",
    "taxon_counts": "taxon string, count long",
}


def schema(name: str) -> T.StructType:
    """The StructType of a kind of file."""
    return T.StructType.fromDDL(DDL[name])
