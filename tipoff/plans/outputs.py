"""Declarative model outputs: which staged table or tables each output is made of."""

from __future__ import annotations

from tipoff.plans.models import Model, distinct, passthrough, projection, union

# Output names. Outputs named <family>_x that pass stg_x through.
PASSTHROUGH = """
fact_assist_leaders fact_assist_tracker fact_box_score_advanced_team fact_box_score_defensive_team fact_box_score_four_factors_team
fact_box_score_hustle_player fact_box_score_misc_team fact_box_score_player_track_team fact_box_score_scoring_team fact_box_score_usage_team
fact_draft_board fact_draft_combine_spot_shooting fact_dunk_score_leaders fact_fantasy_widget fact_franchise_leaders fact_franchise_players
fact_gravity_leaders fact_ist_standings fact_leaders_tiles fact_league_dash_player_stats fact_league_dash_team_stats fact_league_game_finder
fact_league_leaders fact_league_lineup_viz fact_league_opp_pt_shot fact_league_player_pt_shot fact_league_pt_stats fact_league_pt_team_defend
fact_league_team_clutch fact_league_team_pt_shot fact_league_team_shot_locations fact_live_box_score_arena fact_live_odds fact_live_play_by_play
fact_live_score_board fact_play_by_play_v2 fact_player_available_seasons fact_player_awards fact_player_fantasy_profile_last_five_games_avg
fact_player_fantasy_profile_season_avg fact_player_headline_stats fact_player_index fact_player_next_games fact_player_pt_pass
fact_player_pt_shot_defend fact_scoreboard_available fact_scoreboard_win_probability fact_static_players fact_static_teams
fact_team_available_seasons fact_team_awards_championships fact_team_awards_conf fact_team_awards_div fact_team_background fact_team_hof
fact_team_retired fact_team_season_ranks fact_team_social_sites fact_team_streak_finder fact_tracking_defense fact_video_details
fact_video_details_asset fact_video_events fact_video_events_asset fact_video_status
""".split()

# Passthrough outputs whose staged table has another name.
RENAMED = {
    "bridge_live_box_score_official": "stg_live_box_score_officials",
    "fact_box_score_starter_bench": "stg_box_score_traditional_starter_bench",
    "fact_box_score_team": "stg_box_score_traditional_team",
    "fact_defense_hub": "stg_defense_hub_stat1",
    "fact_draft_combine_drill_results": "stg_draft_combine_drills",
    "fact_draft_combine_non_stationary_shooting": "stg_draft_combine_nonstat_shooting",
    "fact_draft_combine_player_anthro": "stg_draft_combine_anthro",
    "fact_draft_combine_stats": "stg_draft_combine",
    "fact_draft_history": "stg_draft",
    "fact_gl_alum_similarity": "stg_gl_alum_box_score_similarity_score",
    "fact_infographic_fanduel_player": "stg_fanduel_player",
    "fact_league_player_shot_locations": "stg_shot_locations",
    "fact_league_pt_defend": "stg_tracking_defense",
    "fact_league_shot_locations": "stg_league_team_shot_locations",
    "fact_live_box_score_game": "stg_live_box_score_game_details",
    "fact_play_by_play_v2_video": "stg_play_by_play_v2_video_available",
    "fact_player_dashboard_clutch_overall": "stg_player_dashboard_clutch",
    "fact_player_dashboard_game_splits_overall": "stg_player_dashboard_game_splits",
    "fact_player_dashboard_general_splits_overall": "stg_player_dashboard_general_splits",
    "fact_player_dashboard_last_n_overall": "stg_player_dashboard_last_n_games",
    "fact_player_dashboard_shooting_overall": "stg_player_dashboard_shooting_splits",
    "fact_player_dashboard_team_perf_overall": "stg_player_dashboard_team_performance",
    "fact_player_dashboard_yoy_overall": "stg_player_dashboard_year_over_year",
    "fact_playoff_series": "stg_common_playoff_series",
    "fact_shot_chart_league": "stg_shot_chart_league_wide",
    "fact_team_dashboard_general_overall": "stg_team_dash_general_splits",
    "fact_team_dashboard_shooting_overall": "stg_team_dash_shooting_splits",
    "fact_team_game_hustle": "stg_box_score_hustle_team",
    "fact_team_history_detail": "stg_team_history",
    "fact_team_lineups_detail": "stg_team_lineups_overall",
    "fact_team_lineups_overall": "stg_team_lineups",
    "agg_player_bio": "stg_league_player_bio",
}

# Outputs that are the distinct rows of one staged table.
DISTINCT = {
    "dim_all_players": "stg_common_all_players",
    "dim_defunct_team": "stg_defunct_teams",
    "dim_official": "stg_officials",
    "dim_season_week": "stg_schedule_weeks",
    "bridge_game_official": "stg_officials",
}

# Tagged unions of staged tables.
UNIONS = {
    "fact_college_rollup": """
        stg_player_college_rollup stg_player_career_by_college_rollup stg_college_rollup_east stg_college_rollup_midwest stg_college_rollup_south
        stg_college_rollup_west
    """.split(),
    "fact_cumulative_stats": """stg_cume_player stg_cume_player_games stg_cume_team stg_cume_team_games""".split(),
    "fact_cumulative_stats_detail": """stg_cume_player_game_by_game stg_cume_player_totals stg_cume_team_game_by_game stg_cume_team_totals""".split(),
    "fact_draft_combine_detail": """
        stg_draft_combine_drills stg_draft_combine_anthro stg_draft_combine_nonstat_shooting stg_draft_combine_spot_shooting
    """.split(),
    "fact_fantasy": """
        fact_infographic_fanduel_player fact_fantasy_widget fact_player_fantasy_profile_last_five_games_avg fact_player_fantasy_profile_season_avg
    """.split(),
    "fact_franchise_detail": """stg_franchise_leaders stg_franchise_players""".split(),
    "fact_homepage": """stg_home_page_v2 stg_homepage_v2""".split(),
    "fact_homepage_leaders": """stg_home_page_leaders stg_homepage_leaders""".split(),
    "fact_hustle_availability": """stg_hustle_stats_available stg_box_score_hustle_box""".split(),
    "fact_league_hustle": """stg_league_hustle_player stg_league_hustle_team stg_league_dash_player_bio_stats""".split(),
    "fact_league_leaders_detail": """fact_league_leaders fact_assist_leaders fact_assist_tracker fact_dunk_score_leaders fact_gravity_leaders""".split(),
    "fact_league_pt_shots": """
        stg_league_pt_stats stg_league_pt_team_defend stg_league_team_pt_shot stg_league_opp_pt_shot stg_league_player_pt_shot
    """.split(),
    "fact_lineup_stats": """stg_lineup stg_team_lineups""".split(),
    "fact_live_box_score_player": """stg_live_box_score_player_stats_home stg_live_box_score_player_stats_away""".split(),
    "fact_live_box_score_team": """stg_live_box_score_team_stats_home stg_live_box_score_team_stats_away""".split(),
    "fact_on_off_detail": """
        stg_on_off_details_overall stg_on_off_details_off_court stg_on_off_details_on_court stg_on_off_summary_overall stg_on_off_summary_off_court
        stg_on_off_summary_on_court
    """.split(),
    "fact_player_game_splits_detail": """
        stg_player_split_actual_margin stg_player_split_by_half stg_player_split_by_period stg_player_split_score_margin
        stg_player_split_game_overall
    """.split(),
    "fact_player_last_n_detail": """
        stg_player_lastn_game_number stg_player_lastn_last10 stg_player_lastn_last15 stg_player_lastn_last20 stg_player_lastn_last5
        stg_player_lastn_overall
    """.split(),
    "fact_player_matchups": """stg_player_vs_player stg_player_compare""".split(),
    "fact_player_matchups_player_info": """stg_pvp_player_info stg_pvp_vs_player_info""".split(),
    "fact_player_pt_reb_detail": """
        stg_player_pt_reb stg_player_pt_reb_overall stg_player_pt_reb_distance stg_player_pt_reb_shot_dist stg_player_pt_reb_shot_type
    """.split(),
    "fact_player_pt_tracking": """
        stg_player_pt_pass stg_player_pt_pass_received stg_player_pt_reb stg_player_pt_shots stg_player_pt_shot_defend
    """.split(),
    "fact_player_season_ranks": """stg_player_season_ranks_regular stg_player_season_ranks_postseason""".split(),
    "fact_player_splits": """
        stg_player_dash_game_splits stg_player_dash_general_splits stg_player_dash_last_n_games stg_player_dash_shooting_splits
        stg_player_dash_team_perf stg_player_dash_yoy
    """.split(),
    "fact_player_team_perf_detail": """stg_player_perf_overall stg_player_perf_pts_scored stg_player_perf_pts_against stg_player_perf_score_diff""".split(),
    "fact_player_yoy_detail": """stg_player_yoy_by_year stg_player_yoy_overall""".split(),
    "fact_scoreboard_conference_standings": """stg_scoreboard_east_conf stg_scoreboard_west_conf""".split(),
    "fact_scoreboard_series_standings": """stg_scoreboard_series_standings stg_scoreboard_v2_series_standings""".split(),
    "fact_scoreboard_v3": """
        stg_scoreboard_v3_broadcaster stg_scoreboard_v3_line_score stg_scoreboard_v3_metadata stg_scoreboard_v3_summary stg_scoreboard_v3_team_stats
    """.split(),
    "fact_season_matchups": """stg_season_matchups stg_matchups_rollup""".split(),
    "fact_shot_chart_league_averages": """stg_shot_chart_league_averages stg_shot_chart_lineup_league_avg""".split(),
    "fact_shot_chart_lineup": """stg_shot_chart_lineup stg_shot_chart_lineup_detail""".split(),
    "fact_streak_finder": """stg_player_streak_finder stg_player_game_streak_finder stg_team_streak_finder""".split(),
    "fact_team_general_splits_detail": """
        stg_team_split_days_rest stg_team_split_location stg_team_split_month stg_team_split_general_overall stg_team_split_pre_post_allstar
        stg_team_split_wins_losses
    """.split(),
    "fact_team_historical": """stg_team_historical_leaders stg_team_year_by_year stg_team_year_by_year_stats""".split(),
    "fact_team_matchups": """stg_team_vs_player stg_team_and_players_vs stg_team_and_players_vs_players""".split(),
    "fact_team_player_dashboard": """stg_team_player_dashboard stg_team_player_dash_players stg_team_player_dash_overall""".split(),
    "fact_team_pt_reb_detail": """
        stg_team_pt_reb stg_team_pt_reb_overall stg_team_pt_reb_distance stg_team_pt_reb_shot_dist stg_team_pt_reb_shot_type
    """.split(),
    "fact_team_pt_shots_detail": """
        stg_team_pt_shots stg_team_pt_shots_closest_def stg_team_pt_shots_dribble stg_team_pt_shots_general stg_team_pt_shots_shot_clock
        stg_team_pt_shots_touch_time
    """.split(),
    "fact_team_pt_tracking": """stg_team_pt_pass stg_team_pt_pass_received stg_team_pt_reb stg_team_pt_shots""".split(),
    "fact_team_splits": """stg_team_dash_general_splits stg_team_dash_shooting_splits""".split(),
}


# Unions with a label of their own: the label's column, the prefix of the staged tables, and each branch's value; a
# branch that isn't the prefix and its value names its table after a colon.
LABELLED = {
    "agg_all_time_leaders": ("stat_category", "stg_all_time_", """
        combined:stg_all_time ast blk dreb fg3a fg3m fg3_pct fga fgm fg_pct fta ftm ft_pct gp oreb pf pts reb stl tov
    """),
    "fact_box_score_summary_v3": ("summary_type", "stg_summary_v3_", """
        game_summary game_info line_score officials other_stats inactive_players last_five_meetings available_video
    """),
    "fact_player_career": ("career_type", "stg_player_career_", """
        regular:stg_player_career_total_regular postseason:stg_player_career_total_postseason total_allstar total_college allstar college
        season_regular:stg_player_career_regular season_postseason:stg_player_career_postseason
    """),
    "fact_player_clutch_detail": ("clutch_window", "stg_player_clutch_", """
        last10sec_3pt2 last10sec_3pt last1min_5pt last1min_pm5 last30sec_3pt2 last30sec_3pt last3min_5pt last3min_pm5 last5min_5pt
        last5min_pm5 overall
    """),
    "fact_player_general_splits_detail": ("split_type", "stg_player_split_", "days_rest location month general_overall pre_post_allstar starting_pos wins_losses"),
    "fact_player_profile": ("profile_type", "stg_player_profile_", """
        career_highs season_highs next_game season_regular:stg_player_profile_regular season_postseason:stg_player_profile_postseason
        season_allstar:stg_player_profile_allstar season_college:stg_player_profile_college season_preseason:stg_player_profile_preseason
        ranks_regular ranks_postseason total_regular total_postseason total_allstar total_college total_preseason
    """),
    "fact_player_pt_shots_detail": ("breakdown_type", "stg_player_pt_shots_", "base:stg_player_pt_shots closest_def dribble general overall shot_clock touch_time"),
    "fact_player_shooting_splits_detail": ("shooting_split", "stg_player_shoot_", """
        assisted_by assisted_shot overall by_5ft:stg_player_shoot_5ft by_8ft:stg_player_shoot_8ft by_area:stg_player_shoot_area
        by_type:stg_player_shoot_type type_summary
    """),
    "fact_scoreboard_detail": ("detail_type", "stg_scoreboard_", """
        available:stg_scoreboard east_conf_standings:stg_scoreboard_east_conf west_conf_standings:stg_scoreboard_west_conf last_meeting
        line_score series_standings v2_series_standings team_leaders ticket_links
    """),
    "fact_team_shooting_splits_detail": ("shooting_split", "stg_team_shoot_", """
        assisted_by assisted_shot overall by_5ft:stg_team_shoot_5ft by_8ft:stg_team_shoot_8ft by_area:stg_team_shoot_area
        by_type:stg_team_shoot_type
    """),
}

# Outputs that are columns of one staged table.
PROJECTIONS = {
    "fact_box_score_four_factors": ("stg_box_score_four_factors_player", """
        game_id team_id player_id effective_field_goal_percentage free_throw_attempt_rate team_turnover_percentage offensive_rebound_percentage
        opp_effective_field_goal_percentage opp_free_throw_attempt_rate opp_team_turnover_percentage opp_offensive_rebound_percentage
    """),
    "fact_game_leaders": ("stg_game_leaders", "game_id team_id leader_type person_id name player_slug jersey_num position team_tricode points rebounds assists"),
    "fact_matchup": ("stg_matchup", "game_id off_player_id def_player_id off_team_id def_team_id matchup_min partial_poss player_pts def_fgm def_fga def_fg_pct"),
    "fact_play_by_play_video": ("stg_play_by_play_video_available", "video_available"),
    "fact_player_estimated_metrics": ("stg_player_tracking", """
        player_id team_id gp w l min e_off_rating e_def_rating e_net_rating e_pace e_ast_ratio e_oreb_pct e_dreb_pct e_reb_pct e_tov_pct
        e_usg_pct season_year
    """),
    "fact_scoreboard_game_header": ("stg_scoreboard", """
        game_date_est game_sequence game_id game_status_id game_status_text gamecode home_team_id visitor_team_id season live_period
        live_pc_time natl_tv_broadcaster_abbreviation home_tv_broadcaster_abbreviation away_tv_broadcaster_abbreviation
        live_period_time_bcast arena_name wh_status
    """),
    "fact_scoreboard_last_meeting": ("stg_scoreboard_last_meeting", """
        game_id last_game_id last_game_date_est last_game_home_team_id last_game_home_team_city last_game_home_team_name
        last_game_home_team_abbreviation last_game_home_team_points last_game_visitor_team_id last_game_visitor_team_city
        last_game_visitor_team_name last_game_visitor_team_city1 last_game_visitor_team_points
    """),
    "fact_scoreboard_line_score": ("stg_scoreboard_line_score", """
        game_date_est game_sequence game_id team_id team_abbreviation team_city_name team_name team_wins_losses pts_qtr1 pts_qtr2 pts_qtr3
        pts_qtr4 pts_ot1 pts_ot2 pts_ot3 pts_ot4 pts_ot5 pts_ot6 pts_ot7 pts_ot8 pts_ot9 pts_ot10 pts fg_pct ft_pct fg3_pct ast reb tov
    """),
    "fact_scoreboard_team_leaders": ("stg_scoreboard_team_leaders", """
        game_id team_id team_city team_nickname team_abbreviation pts_player_id pts_player_name pts reb_player_id reb_player_name reb
        ast_player_id ast_player_name ast
    """),
    "fact_scoreboard_ticket_links": ("stg_scoreboard_ticket_links", "game_id leag_tix"),
    "fact_synergy": ("stg_synergy", """
        player_id team_id season_year entity_type play_type type_grouping gp poss poss_pct ppp pts fgm fga fg_pct efg_pct ft_poss_pct
        tov_poss_pct sf_poss_pct score_poss_pct percentile
    """),
    "fact_team_estimated_metrics": ("stg_team_dashboard_estimated", """
        team_id gp w l min e_off_rating e_def_rating e_net_rating e_pace e_ast_ratio e_oreb_pct e_dreb_pct e_reb_pct e_tov_pct season_year
    """),
    "fact_win_prob_pbp": ("stg_win_prob_pbp", """
        game_id event_num home_pct visitor_pct home_pts visitor_pts home_score_margin period seconds_remaining home_poss_ind home_g description
        location pctimestring isvisible
    """),
    "fact_win_probability": ("stg_win_probability", "game_id event_num period pc_time_string home_pct visitor_pct home_pts visitor_pts home_score_margin"),
}


def branches(prefix: str, values: str) -> dict[str, str]:
    """Value to staged table."""
    return {v.partition(":")[0]: v.partition(":")[2] or prefix + v for v in values.split()}


def label(source: str) -> str:
    """A branch's discriminator: the staged table's name without its prefix."""
    return source.removeprefix("stg_")


def outputs(staged: set[str] | None = None) -> list[Model]:
    """The declarative models; with `staged`, those whose tables are there, unions of the branches that are."""
    there = lambda s: staged is None or s in staged
    single = {o: "stg_" + o.split("_", 1)[1] for o in PASSTHROUGH} | RENAMED
    out = [passthrough(o, s) for o, s in single.items() if there(s)] + [distinct(o, s) for o, s in DISTINCT.items() if there(s)]
    for o, sources in UNIONS.items():
        if live := [s for s in sources if there(s)]:
            out.append(union(o, "source", {label(s): s for s in live}))
    for o, (column, prefix, values) in LABELLED.items():
        if live := {v: s for v, s in branches(prefix, values).items() if there(s)}:
            out.append(union(o, column, live))
    out += [projection(o, s, {c: c for c in columns.split()}) for o, (s, columns) in PROJECTIONS.items() if there(s)]
    return out
