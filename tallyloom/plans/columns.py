"""Column names of the landed vendor tables.

All maps below are fixed values: raw name on the left, dataset name on the right.
"""

BARS_A = {
    "日期": "dt",
    "股票代码": "symbol",
    "开盘": "open",
    "收盘": "close",
    "最高": "high",
    "最低": "low",
    "成交量": "volume",
    "成交额": "amount",
    "振幅": "amplitude",
    "涨跌幅": "change_percent",
    "涨跌额": "change_amount",
    "换手率": "turnover_rate",
}

BARS_B = {
    "trade_date": "dt",
    "ts_code": "symbol",
    "vol": "volume",
    "pct_chg": "change_percent",
}

SPOT = {
    "代码": "symbol",
    "名称": "name",
    "最新价": "current_price",
    "涨跌幅": "change_percent",
    "成交量": "volume",
    "成交额": "amount",
    "开盘价": "open",
    "最高价": "high",
    "最低价": "low",
    "昨收": "pre_close",
}

COMPANY_FACTS = {
    "股票代码": "stock_code",
    "股票简称": "stock_name",
    "总股本": "total_shares",
    "流通股": "circulating_shares",
    "总市值": "total_market_value",
    "流通市值": "circulating_market_value",
    "行业": "industry",
    "上市时间": "listing_date",
}

COMPANY_B = {
    "ts_code": "stock_code",
    "name": "stock_name",
    "total_share": "total_shares",
    "float_share": "circulating_shares",
    "list_date": "listing_date",
}

STATEMENTS_A = {
    "security_code": "symbol",
    "secucode": "symbol_full",
    "security_name_abbr": "symbol_name_abbr",
}

STATEMENTS_B = {"ts_code": "symbol_full"}

INDUSTRY_VALUATION = {
    "成份个数": "stock_count",
    "静态市盈率": "pe_ratio",
    "TTM(滚动)市盈率": "pe_ratio_ttm",
    "市净率": "pb_ratio",
    "静态股息率": "dividend_yield",
}

CONSTITUENTS = {
    "序号": "id",
    "股票代码": "stock_code",
    "股票简称": "stock_name",
    "纳入时间": "inclusion_date",
    "申万3级": "level_3_name",
    "申万3级行业代码": "level_3_code",
    "价格": "price",
    "市盈率": "pe_ratio",
    "市盈率ttm": "pe_ratio_ttm",
    "市净率": "pb_ratio",
    "股息率": "dividend_yield",
    "市值": "market_value",
    "归母净利润同比增长(09-30)": "net_profit_yoy_growth_q3",
    "归母净利润同比增长(06-30)": "net_profit_yoy_growth_q2",
    "营业收入同比增长(09-30)": "revenue_yoy_growth_q3",
    "营业收入同比增长(06-30)": "revenue_yoy_growth_q2",
}

INDEX_WEIGHTS = {
    "日期": "date",
    "指数代码": "index_code",
    "指数名称": "index_name",
    "指数英文名称": "index_name_en",
    "成分券代码": "stock_code",
    "成分券名称": "stock_name",
    "成分券英文名称": "stock_name_en",
    "交易所": "exchange",
    "交易所英文名称": "exchange_en",
    "权重(%)": "weight",
    "纳入日期": "inclusion_date",
    "纳入市值": "inclusion_market_value",
}

SHARE_STRUCTURE = {
    "变更日期": "change_date",
    "总股本": "total_share",
    "流通受限股份": "share_restricted",
    "其他内资持股(受限)": "other_domestic_restricted",
    "境内法人持股(受限)": "domestic_legal_person_restricted",
    "境内自然人持股(受限)": "domestic_natural_person_restricted",
    "已流通股份": "share_circulating",
    "已上市流通A股": "share_circulating_a",
    "变动原因": "change_reason",
}

VALUATION = {
    "数据日期": "date",
    "当日收盘价": "close_price",
    "当日涨跌幅": "price_change_pct",
    "总市值": "total_market_value",
    "流通市值": "circulating_market_value",
    "总股本": "total_shares",
    "流通股本": "circulating_shares",
    "PE(TTM)": "pe_ttm",
    "PE(静)": "pe_static",
    "市净率": "pb_ratio",
    "PEG值": "peg_ratio",
    "市现率": "pcf_ratio",
    "市销率": "ps_ratio",
}

DIVIDENDS = {
    "派息": "dividend",
    "进度": "progress",
    "公告日期": "announcement_date",
    "除权除息日": "ex_date",
    "股权登记日": "record_date",
    "红股上市日": "dividend_share_listing_date",
}

MONEY_SUPPLY = {
    "统计时间": "date",
    "货币和准货币（广义货币M2）": "m2",
    "货币和准货币（广义货币M2）同比增长": "m2_yoy",
    "货币(狭义货币M1)": "m1",
    "货币(狭义货币M1)同比增长": "m1_yoy",
    "流通中现金(M0)": "m0",
    "流通中现金(M0)同比增长": "m0_yoy",
    "活期存款": "demand_deposit",
    "活期存款同比增长": "demand_deposit_yoy",
    "准货币": "quasi_money",
    "准货币同比增长": "quasi_money_yoy",
    "定期存款": "time_deposit",
    "定期存款同比增长": "time_deposit_yoy",
    "储蓄存款": "savings_deposit",
    "储蓄存款同比增长": "savings_deposit_yoy",
    "其他存款": "other_deposit",
    "其他存款同比增长": "other_deposit_yoy",
}

GDP_LABEL = "季度"
GDP_VALUE = "国内生产总值-绝对值"

# Fixed value: progress of a dividend that was carried out.
IMPLEMENTED = "实施"

# Vendor report types and their names. Balance sheets come in the first and third.
REPORT_TYPES = {
    "1": "合并报表",
    "2": "单季合并",
    "6": "母公司报表",
    "7": "母公司单季表",
}
BALANCE_SHEET_TYPES = ("1", "6")

# Company types a statement is split by.
COMPANY_TYPES = ("1", "2", "3", "4")

# Income statement columns read from the landed table.
INCOME_COLUMNS = (
    "ts_code", "ann_date", "f_ann_date", "end_date", "report_type", "comp_type", "end_type",
    "basic_eps", "diluted_eps", "total_revenue", "revenue", "int_income", "prem_earned",
    "comm_income", "n_commis_income", "n_oth_income", "n_oth_b_income", "prem_income", "out_prem",
    "une_prem_reser", "reins_income", "n_sec_tb_income", "n_sec_uw_income", "n_asset_mg_income",
    "oth_b_income", "fv_value_chg_gain", "invest_income", "ass_invest_income", "forex_gain",
    "total_cogs", "oper_cost", "int_exp", "comm_exp", "biz_tax_surchg", "sell_exp", "admin_exp",
    "fin_exp", "assets_impair_loss", "prem_refund", "compens_payout", "reser_insur_liab",
    "div_payt", "reins_exp", "oper_exp", "compens_payout_refu", "insur_reser_refu",
    "reins_cost_refund", "other_bus_cost", "operate_profit", "non_oper_income", "non_oper_exp",
    "nca_disploss", "total_profit", "income_tax", "n_income", "n_income_attr_p", "minority_gain",
    "oth_compr_income", "t_compr_income", "compr_inc_attr_p", "compr_inc_attr_m_s", "ebit",
    "ebitda", "insurance_exp", "undist_profit", "distable_profit", "rd_exp", "fin_exp_int_exp",
    "fin_exp_int_inc", "transfer_surplus_rese", "transfer_housing_imprest", "transfer_oth",
    "adj_lossgain", "withdra_legal_surplus", "withdra_legal_pubfund", "withdra_biz_devfund",
    "withdra_rese_fund", "withdra_oth_ersu", "workers_welfare", "distr_profit_shrhder",
    "prfshare_payable_dvd", "comshare_payable_dvd", "capit_comstock_div",
    "net_after_nr_lp_correct", "credit_impa_loss", "net_expo_hedging_benefits",
    "oth_impair_loss_assets", "total_opcost", "amodcost_fin_assets", "oth_income",
    "asset_disp_income", "continued_net_profit", "end_net_profit", "update_flag",
)
