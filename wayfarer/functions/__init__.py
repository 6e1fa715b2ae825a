"""wayfarer"""
