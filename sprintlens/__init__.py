"""Delivery-quality analytics on Spark DataFrames: will a sprint let a defect escape?"""
