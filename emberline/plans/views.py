"""Example SQL on the published predictions view."""

# --- Fixed values: the SQL texts of the data access layer ---------------------------------
HIGH_POSTS = "SELECT * FROM {view} WHERE viral_potential_label = 'HIGH'"
SUMMARY_OF_DAY = (
    "SELECT viral_potential_label, COUNT(*) AS count FROM {view} "
    "WHERE prediction_date = DATE '{day}' GROUP BY viral_potential_label"
)
TOP_SIMILARITY = (
    "SELECT id, title, viral_similarity_score, is_viral FROM {view} "
    "ORDER BY viral_similarity_score DESC NULLS LAST, id LIMIT 20"
)
LABEL_COUNTS = "SELECT viral_potential_label, COUNT(*) AS count FROM {view} GROUP BY viral_potential_label"
