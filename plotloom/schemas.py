"""Row schemas of the tables that cross a file boundary."""

from pyspark.sql import types as T

POINT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])


def _fields(spec: str) -> T.StructType:
    kinds = {"s": T.StringType(), "i": T.IntegerType(), "d": T.DoubleType(), "b": T.BooleanType(), "l": T.LongType()}
    return T.StructType([T.StructField(n, kinds[k]) for k, n in (w.split(":") for w in spec.split())])


# The columns of one evaluation row, in file order.
FEATURE_ROW = _fields(
    "s:run_id s:run_at s:tool_git_sha s:village s:survey s:mode s:seeds i:pass_no s:imagery_source s:window_sha256 "
    "i:backfilled s:method i:n_candidates d:support_m d:support_next_m d:runner_up_ratio d:boundary_rms_m "
    "i:n_neighbours i:anchor_partners i:side_ok i:side_bad i:contradictions i:printed_far_n d:share d:margin "
    "i:observable i:ambiguous i:in_window d:sigma_pos_m d:sigma_head_deg d:heading_deg d:pose_tx d:pose_ty "
    "d:topo_max_move_m i:topo_clipped s:colour i:confidence_rule s:ref_source d:ref_rms_m d:ref_area_scale "
    "d:ref_stretch_long_pct d:ref_stretch_short_pct d:ref_disagree_mean_m d:ref_disagree_p95_m "
    "d:ref_disagree_corner_mean_m s:stretch_band i:stretched s:stretched_reason i:disputed s:disputed_reason "
    "d:err_fmb_m d:err_hand_m d:heading_err_deg d:max_vertex_err_m i:within_3m s:notes")

# The columns of one status row, in file order.
STATUS_ROW = _fields(
    "s:survey s:status s:method s:colour s:confidence s:share s:margin s:observable s:boundary_rms_m "
    "s:matched_length_m s:support_m s:support_next_m s:n_candidates s:printed_far s:side_ok s:side_bad "
    "s:contradictions s:certain s:anchor_partners s:pass s:in_window s:neighbours s:heading_deg s:pose_tx s:pose_ty "
    "s:shift_m s:sigma_pos_m s:sigma_head_deg s:puvi_reference_m s:puvi_trusted s:puvi_ratio s:anchor_file s:notes "
    "s:file s:fp_placed s:fp_final s:run")

CONTROL_POINT = _fields("s:village s:survey d:map_x d:map_y d:source_x d:source_y")
NEIGHBOUR = T.ArrayType(_fields("s:number s:side i:readers s:confidence"))
PLOT_PROPERTIES = _fields(
    "i:poly_id s:survey_no s:plot_no b:numbered d:area_sqm d:area_are d:area_hect d:perimeter_m i:n_vertices "
    "i:n_holes b:review_needed i:n_labels_in_polygon s:alt_labels s:label_source")
PLOT_FEATURE = T.StructType([
    T.StructField("type", T.StringType()), T.StructField("properties", PLOT_PROPERTIES),
    T.StructField("geometry", T.StructType([
        T.StructField("type", T.StringType()),
        T.StructField("coordinates", T.ArrayType(T.ArrayType(T.ArrayType(T.DoubleType()))))]))])
SHEET_COLLECTION = T.StructType([
    T.StructField("type", T.StringType()), T.StructField("name", T.StringType()),
    T.StructField("features", T.ArrayType(PLOT_FEATURE))])
