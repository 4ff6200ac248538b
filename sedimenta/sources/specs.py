"""Which source a file belongs to: its key, the source row, the type of its evidence, the method of its making, and the format it is read by."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from sedimenta.functions import evidence as ev
from sedimenta.sources import documents, formats


@dataclass(frozen=True)
class Spec:
    key: str
    source: str
    evidence_type: str
    method: str
    format: str

    @property
    def kind(self) -> str:
        """Of the source: rows that only link to a name never date it."""
        return "candidate_only" if self.evidence_type in ev.CANDIDATE_TYPES else "timestamped"

    @property
    def parse(self) -> Callable[[DataFrame], DataFrame]:
        """lines(value, file_name) to records."""
        return formats.FORMATS[self.format] if self.format in formats.FORMATS else getattr(documents, self.format)


# Key, source, evidence type, method, format.
TABLE = """
early_web early_web_cdx cdx_timestamp bulk_cdx_file early_web_cdx
jpnic_register jpnic_register artifact_listing registry_register_listing registry_sections
dartmouth_bfs_seed dartmouth_bfs_seed cdx_timestamp bulk_cdx_file early_web_cdx
internic_zone internic_zone artifact_listing internic_zone_distribution zone_file
iedr_register iedr_register artifact_listing registry_register_listing register_letters
early_bulk_whois_snapshot early_bulk_whois_snapshot whois_creation transcribed_whois_record transcribed_registrations
junkfilter_dated junkfilter_dated_blocklist dated_directory dated_blocklist_release dated_blocklist
junkfilter_candidates junkfilter_mention link_target dated_blocklist_release dated_blocklist
chastity_dated chastity_list_blacklist dated_directory dated_blocklist_release tar_blocklist
chastity_candidates chastity_list_mention link_target dated_blocklist_release tar_blocklist
granitecanyon_dated granitecanyon_zone_rejects artifact_listing hosted_zone_inventory hosted_zones
granitecanyon_candidates granitecanyon_zone_mention link_target hosted_zone_inventory hosted_zones
cctld_capture_dated cctld_register_listing_capture cdx_timestamp registry_listing_capture country_listing
cctld_capture_candidates cctld_register_listing_mention link_target registry_listing_capture country_listing
nz_dns_walk_candidates nz_dns_walk_list_mention link_target usenet_dns_walk_list registry_items
ca_registrations_candidates ca_registrar_registration_mention link_target usenet_registrar_registration_list registry_items
mynic_change_report mynic_my_change_report artifact_listing registry_change_report change_report
coza_deletion_queue coza_deletion_listing cdx_timestamp registry_listing_capture deletion_queue
fac_dated fac_single_audit dated_directory federal_filing_dataset federal_filings
fac_candidates fac_single_audit_mention link_target federal_filing_dataset federal_filings
cctld_register_listing_inbody cctld_register_listing_inbody artifact_listing registry_register_listing country_register
can_domain_registry_notices can_domain_registry_notices whois_creation registry_approval_notice approval_notices
namewinner_expiring namewinner_expiring artifact_listing registrar_expiring_listing expiring_names
ripe_dbase_changed ripe_dbase_changed artifact_listing registry_database_audit_trail changed_short
ripe_dbase_split_2004 ripe_dbase_split_2004 artifact_listing registry_database_audit_trail changed_long
ripe_dbase_1999 ripe_dbase_1999 artifact_listing registry_database_snapshot database_snapshot
squidguard_2001_blacklist squidguard_2001_blacklist artifact_listing robot_compiled_blocklist robot_blacklist
us_domain_delegated us_domain_delegated artifact_listing registry_delegation_listing delegated_zones
isc_survey isc_survey artifact_listing isc_domain_survey host_survey
domain_creation_bulk domain_creation_bulk whois_creation published_registry_creation_dates creation_dates
dartmouth_nber_captures dartmouth_nber_captures cdx_timestamp ia_domain_year_census host_year_census
arquivo_roteiro arquivo_roteiro cdx_timestamp arquivo_cdxj cdxj
arquivo_ia arquivo_ia cdx_timestamp arquivo_cdxj cdxj
ukwa_link_source ukwa_link_source link_source ukwa_host_link_graph link_source
ukwa_geoindex ukwa_geoindex cdx_timestamp bl_geoindex_extract geo_index
afnic_fr afnic_fr whois_creation afnic_open_data registration_span
internet_scout internet_scout dated_directory scout_report_oai report_records
odp odp artifact_listing odp_rdf_dump directory_dump
rdap_snapshot rdap_snapshot whois_creation rdap_journal_file registration_lookup
ukwa_link_target ukwa_link_target link_target ukwa_host_link_graph link_target
ukwa_link_target_bare ukwa_link_target_bare artifact_listing ukwa_host_link_graph bare_link_target
expansion_links page_expansion link_target archived_page_outbound_link page_links
expansion_directory page_directory dated_directory archived_directory_page directory_links
ncsa_whats_new ncsa_whats_new dated_directory ncsa_whats_new_pages announcements
tucows_candidates tucows_mention link_target tucows_release_vendor_url split_journal
tucows_dated tucows_catalogue dated_directory tucows_release_date split_journal
tradepress_dated trade_press dated_directory trade_press_issue_date split_journal
tradepress_candidates trade_press_mention link_target trade_press_ocr_mention split_journal
uucp_listing uucp_map_registry artifact_listing uucp_map_registry_posting split_journal
uucp_creation uucp_map_creation whois_creation uucp_map_registrar_approval split_journal
dk_hostmaster_dk_zonen_domains_txt_wayback_2001 dk_hostmaster_dk_zonen_domains_txt_wayback_2001 artifact_listing registry_zone_list_wayback_capture registry_items
udrp_proceedings udrp_proceedings artifact_listing icann_udrp_proceedings_list dispute_proceedings
attrition_dated attrition_defacement artifact_listing attrition_defacement_mirror_index split_journal
uucp_mentions uucp_map_mention link_target uucp_map_hand_maintained split_journal
rtfm_dated rtfm_faq dated_directory rtfm_faq_revision_date split_journal
rtfm_candidates rtfm_faq_mention link_target rtfm_faq_mention split_journal
usenet_addr_dated usenet_address dated_directory usenet_post_address split_journal
usenet_addr_candidates usenet_address_mention link_target usenet_post_address_mention split_journal
usenet_bare_dated usenet_bare dated_directory usenet_post_bare_host split_journal
usenet_bare_candidates usenet_bare_mention link_target usenet_post_bare_host_mention split_journal
usenet_whois_dated usenet_whois_paste whois_creation transcribed_whois_record pasted_registrations
usenet_whois_candidates usenet_whois_paste_mention link_target usenet_post_whois_mention pasted_registrations
enron_dated enron_email dated_directory enron_message_date split_journal
enron_candidates enron_email_mention link_target enron_message_mention split_journal
maillist_dated maillist_archive dated_directory maillist_message_date split_journal
maillist_candidates maillist_archive_mention link_target maillist_message_mention split_journal
usenet_dated usenet_announce dated_directory usenet_post_date split_journal
usenet_candidates usenet_mention link_target usenet_post_mention split_journal
nypw_firstcdx nypw_firstcdx cdx_timestamp nypw_first_capture_index first_capture
nypw_timemaps nypw_timemaps cdx_timestamp nypw_timemap timemap
nypw_timemaps_nonok nypw_timemaps_nonok cdx_timestamp nypw_timemap_non_200 timemap_non_200
cdx_snapshot ia_cdx_bulk cdx_timestamp ia_cdx_collapsed_query index_snapshot
urlmerchant_dated urlmerchant_inventory artifact_listing broker_inventory_listing split_journal
urlmerchant_candidates urlmerchant_inventory_mention link_target broker_inventory_listing split_journal
jeb_mail_dated jeb_bush_gubernatorial_email dated_directory released_mailbox_sent_date split_journal
jeb_mail_candidates jeb_bush_gubernatorial_email_mention link_target released_mailbox_mention split_journal
"""
SPECS = {spec.key: spec for spec in (Spec(*line.split()) for line in TABLE.strip().splitlines())}
