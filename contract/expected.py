"""Column lists and maps the oracles expect, stated apart from the library.

Fixed values: a column or rule that goes missing in the library is still here, and its
query then differs.
"""

ENTITY_ATTRIBUTES = ('restaurant_name', 'borough', 'building', 'street', 'zipcode', 'phone', 'cuisine_description', 'latitude',
 'longitude', 'community_board', 'council_district', 'census_tract', 'bin', 'bbl', 'nta', 'location')

TEXT_SOURCES = {'restaurant_name': 'DBA',
 'borough': 'BORO',
 'building': 'BUILDING',
 'street': 'STREET',
 'zipcode': 'ZIPCODE',
 'phone': 'PHONE',
 'cuisine_description': 'CUISINE DESCRIPTION',
 'action': 'ACTION',
 'violation_code': 'VIOLATION CODE',
 'violation_description': 'VIOLATION DESCRIPTION',
 'grade': 'GRADE',
 'inspection_type': 'INSPECTION TYPE',
 'nta': 'NTA',
 'location': 'Location'}

IDENTIFIER_SOURCES = {'camis': 'CAMIS',
 'community_board': 'Community Board',
 'council_district': 'Council District',
 'census_tract': 'Census Tract',
 'bin': 'BIN',
 'bbl': 'BBL'}

DOUBLE_SOURCES = {'latitude': 'Latitude', 'longitude': 'Longitude'}

NORMALIZED_COLUMNS = ('camis', 'restaurant_name', 'borough', 'building', 'street', 'zipcode', 'phone', 'cuisine_description',
 'inspection_date', 'action', 'violation_code', 'violation_description', 'critical_flag', 'score', 'grade',
 'grade_date', 'record_date', 'inspection_type', 'latitude', 'longitude', 'community_board', 'council_district',
 'census_tract', 'bin', 'bbl', 'nta', 'location', 'raw_row_hash')

DIMENSIONS = ('borough', 'cuisine_description', 'zipcode', 'nta', 'community_board')

FEATURE_COLUMNS = ('camis', 'cutoff_inspection_id', 'cutoff_date', 'feature_source_max_date', 'violation_feature_source_max_date',
 'prior_cycle_inspection_count', 'prior_cycle_initial_count', 'prior_cycle_reinspection_count',
 'prior_critical_inspection_count', 'prior_cycle_initial_critical_count', 'prior_cycle_reinspection_critical_count',
 'prior_critical_violation_count', 'prior_high_severity_inspection_count', 'prior_cycle_initial_high_severity_count',
 'prior_cycle_reinspection_high_severity_count', 'prior_critical_inspection_rate',
 'prior_high_severity_inspection_rate', 'last_cycle_inspection_date', 'days_since_last_cycle_inspection',
 'last_critical_inspection_date', 'days_since_last_critical_inspection', 'last_high_severity_inspection_date',
 'days_since_last_high_severity_inspection', 'max_historical_score', 'average_historical_score',
 'average_score_last_365d', 'cycle_inspections_last_365d', 'critical_cycle_inspections_last_365d',
 'high_severity_cycle_inspections_last_365d', 'prior_total_violations', 'prior_critical_violation_rows',
 'violations_last_365d', 'critical_violations_last_365d', 'history_depth_bucket', 'has_no_cycle_initial_history',
 'borough', 'cuisine_description', 'zipcode', 'nta', 'community_board')

HISTORY_FEATURES = ('feature_source_max_date', 'violation_feature_source_max_date', 'prior_cycle_inspection_count',
 'prior_cycle_initial_count', 'prior_cycle_reinspection_count', 'prior_critical_inspection_count',
 'prior_cycle_initial_critical_count', 'prior_cycle_reinspection_critical_count', 'prior_critical_violation_count',
 'prior_high_severity_inspection_count', 'prior_cycle_initial_high_severity_count',
 'prior_cycle_reinspection_high_severity_count', 'prior_critical_inspection_rate',
 'prior_high_severity_inspection_rate', 'last_cycle_inspection_date', 'days_since_last_cycle_inspection',
 'last_critical_inspection_date', 'days_since_last_critical_inspection', 'last_high_severity_inspection_date',
 'days_since_last_high_severity_inspection', 'max_historical_score', 'average_historical_score',
 'average_score_last_365d', 'cycle_inspections_last_365d', 'critical_cycle_inspections_last_365d',
 'high_severity_cycle_inspections_last_365d', 'prior_total_violations', 'prior_critical_violation_rows',
 'violations_last_365d', 'critical_violations_last_365d', 'history_depth_bucket', 'has_no_cycle_initial_history')

LABEL_COLUMNS = ('camis', 'cutoff_inspection_id', 'cutoff_date', 'cutoff_inspection_type', 'cutoff_is_cycle_initial',
 'cutoff_is_cycle_reinspection', 'target_inspection_id', 'target_inspection_date', 'target_inspection_type',
 'days_to_target', 'target_total_violations', 'target_critical_violation_count', 'target_noncritical_violation_count',
 'target_score', 'target_grade', 'target_action', 'target_any_critical', 'target_two_or_more_critical',
 'target_three_or_more_critical', 'target_four_or_more_critical', 'target_high_severity', 'target_label')

POPULATION_COLUMNS = ('cutoff_inspection_id', 'camis', 'cutoff_date', 'cutoff_inspection_type', 'cutoff_is_cycle_initial',
 'cutoff_is_cycle_reinspection', 'target_inspection_id', 'target_inspection_date', 'target_inspection_type',
 'days_to_target')

NON_NEGATIVE = ('prior_cycle_inspection_count', 'prior_cycle_initial_count', 'prior_cycle_reinspection_count',
 'prior_critical_inspection_count', 'prior_critical_violation_count', 'cycle_inspections_last_365d',
 'critical_cycle_inspections_last_365d')

PART_OF = (('prior_critical_inspection_count', 'prior_cycle_inspection_count'),
 ('prior_cycle_initial_critical_count', 'prior_cycle_initial_count'),
 ('prior_cycle_reinspection_critical_count', 'prior_cycle_reinspection_count'),
 ('critical_cycle_inspections_last_365d', 'cycle_inspections_last_365d'))
