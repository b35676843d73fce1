"""The eight replicated tables: key, columns with types, and which columns a later change may overwrite."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class ReplicatedTable:
    name: str
    topic: str
    key: str
    columns: dict[str, str]
    update: tuple[str, ...]


def _table(name: str, topic: str, key: str, ddl: str, update: str | None = None, keep: tuple[str, ...] = ()) -> ReplicatedTable:
    columns = dict(part.split() for part in ddl.replace("\n", " ").split(",") if part.strip())
    chosen = tuple(update.split()) if update else tuple(c for c in columns if c != key and c not in keep)
    return ReplicatedTable(name, topic, key, columns, chosen)


# Column names and types of the source tables. The creation time of a list entry is set once.
TABLES = {
    t.name: t
    for t in [
        _table(
            "dm_blacklist_ent", "black_gray", "id",
            "id int, gray_ent_id int, ent_name string, is_effect int, is_show int, is_open int, rule_desc string, has_operation int, "
            "operation_detail string, effective_day string, effective_day_desc string, operator string, create_time string, update_time string",
            keep=("create_time",),
        ),
        _table(
            "dm_blacklist_worktype", "black_gray", "id",
            "id int, work_name string, guide_words string, type string, status string, start_date string, create_time string, update_time string",
            keep=("create_time",),
        ),
        _table(
            "dm_ent_rule_relation", "black_gray", "id",
            "id int, ent_id int, ent_type string, rule_id int, rule_type string, is_effect int, is_open int, has_operation int, "
            "operation_detail string, effective_day string, effective_day_desc string, operator string, create_time string, update_time string",
            keep=("create_time",),
        ),
        _table(
            "dm_graylist_ent", "black_gray", "id",
            "id int, ent_name string, is_effect int, is_show int, is_open int, has_operation int, operation_detail string, "
            "effective_day string, effective_day_desc string, operator string, create_time string, update_time string",
            keep=("create_time",),
        ),
        _table(
            "dm_graylist_rule", "black_gray", "id",
            "id int, rule_type string, rule_code string, rule_name string, rule_desc string, sort int, status int, operator string, "
            "create_time string, update_time string",
            keep=("create_time",),
        ),
        _table("piwik_log_action", "piwik", "idaction", "idaction int, name string, hash bigint, type int, url_prefix int"),
        _table(
            "piwik_log_link_visit_action", "piwik", "idlink_va",
            "idlink_va bigint, idsite int, idvisitor string, idvisit bigint, idaction_url_ref int, idaction_name_ref int, custom_float float, "
            "server_time string, idpageview string, interaction_position int, idaction_name int, idaction_url int, time_spent_ref_action int, "
            "idaction_event_action int, idaction_event_category int, idaction_content_interaction int, idaction_content_name int, "
            "idaction_content_piece int, idaction_content_target int, custom_var_k1 string, custom_var_v1 string, custom_var_k2 string, "
            "custom_var_v2 string, custom_var_k3 string, custom_var_v3 string, custom_var_k4 string, custom_var_v4 string, "
            "custom_var_k5 string, custom_var_v5 string",
        ),
        _table(
            "piwik_log_visit", "piwik", "idvisit",
            "idvisit bigint, idsite int, idvisitor string, visit_last_action_time string, config_id string, location_ip string, user_id string, "
            "visit_first_action_time string, visit_goal_buyer int, visit_goal_converted int, visitor_days_since_first int, "
            "visitor_days_since_order int, visitor_returning int, visitor_count_visits int, visit_entry_idaction_name int, "
            "visit_entry_idaction_url int, visit_exit_idaction_name int, visit_exit_idaction_url int, visit_total_actions int, "
            "visit_total_interactions int, visit_total_searches int, referer_keyword string, referer_name string, referer_type int, "
            "referer_url string, location_browser_lang string, config_browser_engine string, config_browser_name string, "
            "config_browser_version string, config_device_brand string, config_device_model string, config_device_type int, config_os string, "
            "config_os_version string, visit_total_events int, visitor_localtime string, visitor_days_since_last int, config_resolution string, "
            "config_cookie int, config_director int, config_flash int, config_gears int, config_java int, config_pdf int, config_quicktime int, "
            "config_realplayer int, config_silverlight int, config_windowsmedia int, visit_total_time int, location_city string, "
            "location_country string, location_latitude double, location_longitude double, location_region string, "
            "custom_var_k1 string, custom_var_v1 string, custom_var_k2 string, custom_var_v2 string, custom_var_k3 string, custom_var_v3 string, "
            "custom_var_k4 string, custom_var_v4 string, custom_var_k5 string, custom_var_v5 string",
            update="visit_first_action_time visit_goal_buyer visit_goal_converted visitor_days_since_first visitor_days_since_order "
            "visitor_returning visitor_count_visits visit_entry_idaction_name visit_entry_idaction_url visit_exit_idaction_name "
            "visit_exit_idaction_url visit_total_actions visit_total_interactions visit_total_searches",
        ),
    ]
}
